"""There is no streaming source in the domain. The projections and filters of `operators.sequence` that add no join
(degap, underscore_headers, max_char, length_range) work on streaming frames unchanged."""

"""DataFrame operators over sequence records, lineages, taxonomy and places."""

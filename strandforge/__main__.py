"""python -m strandforge [options] [subcommand [options]]...; STRANDFORGE_DATA names the data folder."""

import os
import sys

from pyspark.sql import SparkSession

from .plans.command import asked_cores, main

try:
    builder, cores = SparkSession.builder, asked_cores(sys.argv[1:])
    if cores:  # of a cluster, or of this machine where no cluster is set
        builder = builder.config("spark.cores.max", cores)
        if not os.environ.get("MASTER") and "--master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
            builder = builder.master(f"local[{cores}]")
    print("\n".join(main(builder.getOrCreate(), sys.argv[1:], os.environ.get("STRANDFORGE_DATA", "."))))
except ValueError as e:
    sys.exit(str(e))

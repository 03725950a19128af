"""Cluster entry point for the star-schema job.

    zip -r yellowstar.zip yellowstar
    spark-submit --py-files yellowstar.zip submit.py --source DIR --sink DIR [--partition-by-month]
"""

from yellowstar.pipeline import main

if __name__ == "__main__":
    main()

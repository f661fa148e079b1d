"""Batch job: spark-submit --py-files <zipped sessionloom> run_etl.py --raw-dir ... (see --help)."""

from sessionloom.plans.etl import main

if __name__ == "__main__":
    raise SystemExit(main())

"""spark-submit entry point: ``spark-submit --py-files stratum.zip submit.py <stage>``.

Stages: bronze, silver, gold (stream + snapshot), snapshot, chain, fanout.
Settings come from ``STRATUM_*`` environment variables.
"""

from stratum.plans.chain import main

if __name__ == "__main__":
    main()

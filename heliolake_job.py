"""spark-submit launcher: ``spark-submit --py-files heliolake.zip heliolake_job.py --date_t ...``
(see ``heliolake.plans.pipeline.job_main`` for the options)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from heliolake.plans.pipeline import job_main  # noqa: E402

if __name__ == "__main__":
    job_main()

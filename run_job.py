"""``spark-submit run_job.py JOB …``; see ``starmill.jobs`` for the jobs and their arguments."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmill.jobs import main  # noqa: E402

sys.exit(main())

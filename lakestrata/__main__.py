import sys

from lakestrata.plans.cli import main

sys.exit(main())

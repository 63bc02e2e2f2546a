import sys

from velostat.cli import main

sys.exit(main())

import sys

from minekit.cli import main

sys.exit(main())

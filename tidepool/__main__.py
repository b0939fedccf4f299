import sys

from tidepool.cli import main

sys.exit(main())

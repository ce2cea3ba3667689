import sys

from chalkline.cli import main

sys.exit(main())

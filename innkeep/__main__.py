"""``python -m innkeep``: the catalog pipeline; ``python -m innkeep fuzzy``: the fuzzy mapping program."""

import sys

from innkeep.plans import fuzzy_run, run

if __name__ == "__main__":
    sys.exit(fuzzy_run.main(sys.argv[2:]) if sys.argv[1:2] == ["fuzzy"] else run.main())

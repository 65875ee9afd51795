"""``python -m streamledger <app> ...``: see ``streamledger.streaming.apps``."""

from streamledger.streaming.apps import main

if __name__ == "__main__":
    main()

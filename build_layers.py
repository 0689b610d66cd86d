"""Entry point for spark-submit; see ``assayer.plans.layers``."""

from assayer.plans.layers import main

if __name__ == "__main__":
    main()

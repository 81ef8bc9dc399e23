"""Entry script for spark-submit; see smelter.jobs."""

from smelter.jobs import main

if __name__ == "__main__":
    main()

"""For ``spark-submit``: the fleet streams."""

from haulmark.job import main

if __name__ == "__main__":
    main()

"""``spark-submit jobs.py <job> --root <folder>``; see ``millrace/jobs.py``."""

from millrace.jobs import main

if __name__ == "__main__":
    main()

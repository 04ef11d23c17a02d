"""Entry script for spark-submit: ``spark-submit ... jobs.py <step> [options]``
(same steps as ``python -m fleetspark``)."""

from fleetspark.__main__ import main

if __name__ == "__main__":
    main()

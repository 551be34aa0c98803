"""spark-submit entry point: ``spark-submit --py-files sprout.zip sprout_submit.py --mod train ...``.

Same options as ``python -m sprout`` (see sprout/cli.py).
"""

from sprout.cli import main

if __name__ == "__main__":
    main()

"""spark-submit entry point for the batch job.

    zip -r ebbtide.zip ebbtide
    spark-submit --py-files ebbtide.zip run_lists.py --customers ... --orders ... \
        --subscriptions ... --metros ... --as-of "2020-08-14 12:00:00" --out <folder>
"""

from ebbtide.run import main

if __name__ == "__main__":
    main()

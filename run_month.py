"""spark-submit entry for the month job: spark-submit --py-files fareline.zip run_month.py --warehouse ..."""

from fareline.plans.month_job import main

if __name__ == "__main__":
    main()

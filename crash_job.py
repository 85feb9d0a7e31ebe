"""Launcher for the crash warehouse jobs.

    zip -r starforge.zip starforge
    spark-submit --py-files starforge.zip crash_job.py build --raw ... --served ... --as-of 2024-01-16
"""

from starforge.plans.crash import main

if __name__ == "__main__":
    main()

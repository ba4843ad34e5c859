"""railflow: rail timetable ETL and analytics as Spark DataFrame jobs.

Every public function takes DataFrames (and plain parameters) and returns a
lazy DataFrame; nothing is collected to the driver except the small
loop-control counts of the two graph searches.
"""

__version__ = "0.1.0"

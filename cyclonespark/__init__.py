"""cyclonespark: tropical-cyclone track, flood-survey and station analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``)
that works on all storms, advisories and forecast cycles at once.
"""

__version__ = "0.1.0"

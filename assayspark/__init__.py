"""Spark operators for tables of measured activity.

Every public function takes DataFrames and column names and returns DataFrames (fitted things also
return the fitted model). Nothing here collects row data.
"""

from assayspark.session import session, shared_folder

__all__ = ["session", "shared_folder"]

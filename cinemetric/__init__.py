"""cinemetric: a media-catalogue analytics engine written as plain Spark DataFrame jobs.

Every public function takes DataFrames (and plain parameters) and returns a lazy DataFrame;
nothing in the library collects data to the driver.
"""

from cinemetric.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

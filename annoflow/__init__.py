"""annoflow: a PySpark pipeline for social-media statuses and crowd annotations.

Every public function takes and returns DataFrames; sessions are created only
by callers (see :mod:`annoflow.session`).
"""

__version__ = "0.1.0"

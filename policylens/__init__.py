"""policylens: car-insurance pricing and model monitoring on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``)
built from Spark SQL expressions, so Catalyst plans, prunes and pushes down
the whole job. Python runs inside tasks only for the tree-explanation job.
"""

from policylens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

"""Column-level helpers."""

from cohortlab.functions.columns import *  # noqa: F401,F403

"""larder: a Spark-native batch analytics package for meal invoices, order leads,
sales-team assignments and the participants named on each invoice.

Layout
------
sources/    raw-table builders (CSV scan, test-table domain), schemas, publishing
functions/  column expressions (date parsing, part of day, participant count, rounding)
operators/  DataFrame-to-DataFrame steps (cleaning, participant explode and ids,
            profiling, integrity checks, schema conformance and collation)
plans/      the reporting views, their previews and their registration by name
job         the whole batch job from three CSV paths (``python -m larder``)
"""

from larder.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]

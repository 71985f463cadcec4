"""Registry of oracle SQL strings, keyed like ``queries.REGISTRY``."""

from __future__ import annotations

from tidemark.plans import oracle as O


def oracle_sql() -> dict[str, str]:
    q = {"training_frame": O.training_frame()}
    q.update(O.batch_sql())
    q.update(O.stream_sql())
    q.update(O.ml_sql())
    q["long_series_features"] = O.long_series_sql()
    q["to_json_value"] = O.json_value_sql()
    return {k: O.nudge_rounding(v) for k, v in q.items()}

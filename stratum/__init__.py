"""stratum - a Spark-native medallion engine for event-based financial data products.

Layers: JSON-lines landing -> bronze (raw + provenance) -> silver (normalised,
validated, rejects quarantined) -> gold (event-time window summaries), with
named reports, layer audits and replay-safe streaming sinks, all expressed as
DataFrame / SQL / Structured Streaming jobs.

    from stratum import Settings, build_session, chain
    spark = build_session("jobs")
    chain.run_chain(spark, Settings.from_env())
"""

__version__ = "0.1.0"

from stratum.session import build_session  # noqa: E402
from stratum.settings import Layer, Settings  # noqa: E402

__all__ = ["Layer", "Settings", "build_session", "chain"]


def __getattr__(name):  # lazy: the job module pulls in every operator
    if name == "chain":
        from stratum.plans import chain

        return chain
    raise AttributeError(name)

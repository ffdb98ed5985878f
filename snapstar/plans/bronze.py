"""Bronze stages: publish what is good, keep what is bad apart, then fail.

A batch of responses is judged once by the contract of its source.  Responses
that keep it are committed to the bronze table, the others to a quarantine table
with the names of the rules they break; both are versioned tables, merged on
``request_id``, so that a replay adds nothing.  Only then does the gate speak: one
bad response, or one request that has no good response, fails the run, and
nothing that was good is lost by it.

A landed response keeps its request id and its time, so a replay comes with the
same ingestion date: the check for known ids reads the days of the batch only.
The driver sees counts, and a bounded list of what failed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.functions import json as JS
from snapstar.operators import quality as Q
from snapstar.plans import dims as D
from snapstar.plans import transit as TR
from snapstar.session import stage
from snapstar.sources import versions as V

#: Failures that an error names.
NAMED = 20
DAY = ["ingestion_date"]


class IncompleteIngestion(RuntimeError):
    """Some responses broke their contract, or some requests have no good
    response.  The good responses are committed."""


@dataclass(frozen=True)
class Publication:
    """What one run has done with its batch."""

    dataset: str
    responses: int
    committed: int
    quarantined: int
    unanswered: int
    bronze_version: int
    failures: tuple[str, ...]

    @property
    def replayed(self) -> int:
        """Good responses that were there already, or twice in the batch, and bad ones likewise."""
        return self.responses - self.committed - self.quarantined

    def gate(self) -> Publication:
        if self.failures:
            more = f" and more ({NAMED} are named)" if len(self.failures) == NAMED else ""
            raise IncompleteIngestion(f"{self.dataset}: {self.committed} responses committed; failed: {', '.join(self.failures)}{more}")
        return self


def outcomes(judged: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (source_endpoint and more) with the responses to each, how many
    kept the contract, and ``outcome``: succeeded, failed or unanswered."""
    per = judged.groupBy("source_endpoint").agg(F.count("*").alias("responses"), F.count_if(F.size(Q.FAILED) == 0).alias("good"))
    out = requests.join(per, "source_endpoint", "left").fillna(0, ["responses", "good"])
    return out.withColumn("outcome", F.when(F.col("good") > 0, "succeeded").when(F.col("responses") > 0, "failed").otherwise("unanswered"))


def judge(responses: DataFrame, contract: Callable[[Column], list[Q.Rule]]) -> DataFrame:
    """The responses with the names of the rules that each breaks; each payload is
    parsed once, for all rules."""
    return stage(Q.with_failures(JS.with_body(responses), contract(F.col(JS.BODY))).drop(JS.BODY), "judged-responses", "zstd")


def publish(spark: SparkSession, dataset: str, judged: DataFrame, bronze: str, quarantine: str, requests: DataFrame | None = None,
            partition_by: Sequence[str] = DAY) -> Publication:
    """Commit the good responses, then the bad ones, then look at what is missing.

    ``requests`` names the endpoints that must have a good response.  Tables are
    partitioned by day, as a batch holds the responses of a run; a back-load of
    years with few responses a day is better left whole (no ``partition_by``)."""
    bad = F.size(Q.FAILED) > 0
    layout = {"partition_by": partition_by, "within": partition_by}
    version = V.merge_insert_only(spark, judged.where(~bad).drop(Q.FAILED), bronze, ["request_id"], **layout)
    held = V.merge_insert_only(spark, judged.where(bad), quarantine, ["request_id"], **layout)
    total = judged.agg(F.count("*").alias("n"), F.count_if(bad).alias("bad")).first()
    failures = [f"{r['request_id']} ({', '.join(r[Q.FAILED])})" for r in judged.where(bad).orderBy("request_id").limit(NAMED).collect()] if total["bad"] else []
    unanswered = 0
    if requests is not None:
        open_ = outcomes(judged, requests).where("outcome <> 'succeeded'")
        unanswered = open_.count()
        failures += [f"{r['source_endpoint']} ({r['outcome']})" for r in open_.orderBy("source_endpoint").limit(NAMED).collect()]
    return Publication(dataset, total["n"], V.entry(spark, bronze, version)["rows_written"], V.entry(spark, quarantine, held)["rows_written"],
                       unanswered, version, tuple(failures[:NAMED]))


def _stage(dataset: str, contract: Callable[[Column], list[Q.Rule]]):
    def run(spark: SparkSession, responses: DataFrame, base: str, requests: DataFrame | None = None, strict: bool = True, partition_by: Sequence[str] = DAY) -> Publication:
        done = publish(spark, dataset, judge(responses, contract), f"{base}/{dataset}", f"{base}/{dataset}_quarantine", requests, partition_by)
        return done.gate() if strict else done

    run.__name__ = run.__qualname__ = f"bronze_{dataset}"
    run.__doc__ = (f"Publish a batch of {dataset.replace('_', ' ')} responses below ``base``; with ``strict`` (else the caller looks at the "
                   "failures) a bad or missing one fails the run once the good ones are committed.")
    return run


bronze_line_status = _stage("line_status", TR.line_status_contract)
bronze_stop_points = _stage("stop_points", TR.stop_points_contract)
bronze_weather = _stage("weather", TR.weather_contract)
bronze_holidays = _stage("bank_holidays", TR.holidays_contract)
_arrivals = _stage("arrivals", TR.arrivals_contract)


def arrival_requests(stations: DataFrame, stop_points: DataFrame) -> DataFrame:
    """``station_name, station_id, source_endpoint``: the request to make for each
    configured station.  A name without a station, or with several, is an error."""
    resolved = stage(D.resolve_names(stations, stop_points, "station_name", "station_id"), "resolved-stations")
    D.gate_resolution(resolved)
    return resolved.select("station_name", F.col("resolved_id").alias("station_id"), F.concat(F.lit("/StopPoint/"), F.col("resolved_id"), F.lit("/Arrivals")).alias("source_endpoint"))


def bronze_arrivals(spark: SparkSession, responses: DataFrame, base: str, requests: DataFrame, strict: bool = True, partition_by: Sequence[str] = DAY) -> Publication:
    """As the other stages, with the requests that must be answered (from
    :func:`arrival_requests`); an empty list is an answer."""
    return _arrivals(spark, responses, base, requests, strict, partition_by)

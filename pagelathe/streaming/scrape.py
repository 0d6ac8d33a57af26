"""Continuous paths: rate limits per site, and watching for pages to annotate."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.ranking import bucketed_rank
from ..operators.review import unannotated
from ..operators.skew import spread_join


def schedule(arrivals: DataFrame, delay: float, key: str = "domain", at: str = "arrival", span: float = 3600.0) -> DataFrame:
    """`arrivals` with start: when each may begin, if those of one key keep `delay` seconds apart; times are numbers.

    start_i = max(arrival_i, start_{i-1} + delay) has the closed form
    max_j<=i (arrival_j - (j-1) delay) + (i-1) delay, a running maximum. Ties
    of arrival keep the order of `seq`. Ranks and maxima are taken in spans of
    `span` seconds and carried over from one span to the next, so a busy key is
    no single task.
    """
    bucket = F.floor(F.col(at) / span)
    ranked = bucketed_rank(arrivals, [key], F.struct(at, "seq"), bucket).withColumn("__span", bucket)
    early = ranked.withColumn("__early", F.col(at) - (F.col("rank") - 1) * delay)
    before = Window.partitionBy(key).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    spans = early.groupBy(key, "__span").agg(F.max("__early").alias("__most")).withColumn("__carried", F.max("__most").over(before)).drop("__most")
    inside = Window.partitionBy(key, "__span").orderBy(at, "seq").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.greatest(F.max("__early").over(inside), F.col("__carried"))
    return early.join(spans, [key, "__span"]).select(*arrivals.columns, (latest + (F.col("rank") - 1) * delay).alias("start"))


def schedule_stream(arrivals: DataFrame, delay: float) -> DataFrame:
    """The same for a stream (domain, arrival, seq): the state of a domain is its last start.

    Rows of a micro-batch are taken in the order of arrival and seq; later
    batches follow earlier ones.
    """

    def step(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(frames)).sort_values(["arrival", "seq"], kind="stable")
        starts = []
        for at in rows["arrival"]:
            last = float(at) if last is None else max(float(at), last + delay)
            starts.append(last)
        state.update((last,))
        yield rows.assign(start=starts)[["domain", "arrival", "seq", "start"]]

    out = T.StructType([T.StructField("domain", T.StringType()), T.StructField("arrival", T.DoubleType()), T.StructField("seq", T.LongType()), T.StructField("start", T.DoubleType())])
    held = T.StructType([T.StructField("last", T.DoubleType())])
    return arrivals.groupBy("domain").applyInPandasWithState(step, out, held, "append", "NoTimeout")


def watch(pages_stream: DataFrame, annotations: Callable[[], DataFrame], handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "30 seconds"):
    """Start a query that hands each batch of new successful pages without annotation to `handle`.

    `annotations` is called for every batch, so pages annotated meanwhile are
    left out. The checkpoint folder makes the query go on where it stopped.
    Without `every` the query takes what there is and ends.
    """

    def batch(rows: DataFrame, epoch: int) -> None:
        handle(unannotated(rows, annotations()), epoch)

    when = {"processingTime": every} if every else {"availableNow": True}
    return pages_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**when).start()


def allowed(pages: DataFrame, robots: DataFrame) -> DataFrame:
    """Pages that the rules of their origin let fetch; an origin without rules lets everything.

    `robots` has origin, prefix and allow; of the matching prefixes the longest
    counts, of equally long ones the allowing.
    """
    origin = F.lower(F.regexp_extract("url", r"^([a-zA-Z]+://[^/?#]+)", 1))
    path = F.regexp_replace("url", r"^[a-zA-Z]+://[^/?#]+", "")
    rules = robots.groupBy("origin").agg(F.collect_list(F.struct(F.length("prefix").alias("n"), "allow", "prefix")).alias("rules"))
    joined = pages.withColumn("origin", origin).withColumn("path", F.when(path == "", "/").otherwise(path)).join(rules, "origin", "left")
    hit = F.array_max(F.filter(F.coalesce("rules", F.array()), lambda r: F.startswith(F.col("path"), r["prefix"])))
    return joined.where(F.coalesce(hit["allow"], F.lit(True))).drop("origin", "path", "rules")


def allowed_by_files(pages: DataFrame, files: DataFrame, agent: str = "*") -> DataFrame:
    """Pages that the robots file of their origin lets `agent` fetch.

    `files` has origin, status and text, one row an origin; an origin without a
    file, with another status than 200 or with null text lets everything. The
    rules of an origin are read once a worker, whatever the number of its pages.
    """
    origin = F.lower(F.regexp_extract("url", r"^([a-zA-Z]+://[^/?#]+)", 1))
    rules = files.where("status = 200").groupBy(F.lower("origin").alias("__origin")).agg(F.max("text").alias("__rules"))

    @F.pandas_udf("boolean")
    def may(url: pd.Series, text: pd.Series) -> pd.Series:
        known: dict[str, RobotFileParser] = {}
        out = []
        for u, t in zip(url, text):
            if t not in known:
                known[t] = RobotFileParser()
                known[t].parse(t.splitlines())
            out.append(known[t].can_fetch(agent, u))
        return pd.Series(out)

    joined = spread_join(pages.withColumn("__origin", origin), rules, ["__origin"], ["url"], "left")
    free = joined.where("__rules is null").drop("__origin", "__rules")
    return free.unionByName(joined.where("__rules is not null").where(may("url", "__rules")).drop("__origin", "__rules"))


class Progress(StreamingQueryListener):
    """Keeps what the batches of all streams of a session took in: (name or id, batch, rows, rows a second)."""

    def __init__(self):
        self.batches: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append((p.name or str(p.id), p.batchId, p.numInputRows, p.processedRowsPerSecond))

    def onQueryTerminated(self, event) -> None:
        pass


def with_retries(fetch: Callable[[str], str], retries: int = 2) -> Callable[[str], tuple[str | None, str | None]]:
    """`fetch` tried up to retries + 1 times: (text, None), or (None, the last error)."""

    def tried(url: str) -> tuple[str | None, str | None]:
        error = None
        for _ in range(retries + 1):
            try:
                return fetch(url), None
            except Exception as e:  # whatever a fetcher raises is an outcome
                error = str(e) or type(e).__name__
        return None, error

    return tried


def scrape(pages: DataFrame, fetch: Callable[[str], str], retries: int = 2, runners: int | None = None) -> DataFrame:
    """(page_id, status, error, html, markdown) for pages (page_id, url): what a fetcher that runs on the executors returns.

    With `runners`, at most so many pages are fetched at a time: each task
    fetches one page after the other, and there are no more tasks. Pages of one
    host share a task, so that its delay can be kept there.
    """
    from ..operators.html_walk import to_markdown

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = with_retries(fetch, retries)
        for frame in frames:
            rows = []
            for page, url in zip(frame["page_id"], frame["url"]):
                html, error = get(url)
                rows.append((page, "failed" if html is None else "success", error, html, to_markdown(html, url) if html is not None else None))
            yield pd.DataFrame(rows, columns=["page_id", "status", "error", "html", "markdown"])

    todo = pages.select("page_id", "url")
    if runners is not None:
        todo = todo.repartition(runners, F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]+)", 1)))
    return todo.mapInPandas(run, "page_id bigint, status string, error string, html string, markdown string")


def scrape_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count("*").alias("n"))

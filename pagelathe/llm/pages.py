"""Running the page models over all pages, one pass over the html."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.current import latest
from ..operators.html_walk import walk
from ..operators.sampling import smallest_hashes
from ..sources.tables import use_checkpoints
from .lines import lines_of
from .page_model import SAMPLE, PageModel, fit_body, sample_page
from .residue_model import EVIDENCE, EVIDENCE_DDL, evidence_of, fit_residue, with_residue

#: Bound of the sample of labelled pages that the body model is fitted on.
LABELLED = 2000
#: Longer pages are left out of that sample, so that it is bounded in bytes too.
SAMPLE_CHARS = 100_000


def validated_annotations(annotations: DataFrame) -> DataFrame:
    """(page_id, ranges, source) of pages whose current annotation is validated."""
    kept = ["validated", "source", "ranges", "created_at"]
    return latest(annotations, "page_id", "updated_at", kept).where("validated").select("page_id", "ranges", "source")


def fit_body_model(pages: DataFrame, annotations: DataFrame, labelled: int = LABELLED, model: PageModel | None = None) -> PageModel:
    """Fit the body model on at most `labelled` pages with a current, manual and validated annotation with ranges.

    The sample is drawn from the annotations alone, those with the smallest
    hashes of page_id, so it depends neither on order nor on partitions. Its
    lines are made where the pages lie; only they reach the driver.
    """
    model = model or PageModel()
    labels = validated_annotations(annotations).where((F.col("source") == "manual") & (F.size("ranges") > 0))
    ranges = F.col("ranges").cast("array<struct<start:int,end:int>>").alias("ranges")
    wanted = F.broadcast(smallest_hashes(labels.select("page_id", "ranges"), "page_id", labelled, 1).select("page_id", ranges))
    own = [("page_id", pa.int64()), ("at", pa.int64()), ("tie", pa.int64())]
    schema = pa.schema([pa.field(*f) for f in own] + list(SAMPLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sample_page(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("html", "url", "ranges")))]
            arrays = [batch.column(n) for n, _ in own] + [pa.array([g[f.name] for g in got], f.type) for f in SAMPLE]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    ddl = "page_id bigint, at bigint, tie bigint" + _ddl_of(SAMPLE)
    chosen = (
        pages.where(F.col("html").isNotNull() & (F.length("html") <= SAMPLE_CHARS) & (F.col("status") == "success"))
        .select(F.col("page_id").cast("bigint"), F.col("scraped_at").cast("timestamp"), "url", "html")
        .join(wanted, "page_id")
        .select("page_id", F.coalesce(F.unix_micros("scraped_at"), F.lit(-(2**63))).alias("at"), F.xxhash64("html").alias("tie"), "html", "url", "ranges")
    )
    sample = chosen.mapInArrow(run, ddl).toArrow()
    newest: dict = {}
    for i, k in sorted(enumerate(sample.select(["page_id", "at", "tie"]).to_pylist()), key=lambda x: (x[1]["at"], x[1]["tie"])):
        newest[k["page_id"]] = i
    fit_body(model, sample.take(pa.array([newest[k] for k in sorted(newest)], pa.int64())))
    return model


def map_pages(pages: DataFrame, model: PageModel, fields: pa.Schema, result: Callable, carry: tuple[str, ...] = ()) -> DataFrame:
    """Apply `result` to every row of pages that has html; one row each, with the columns of `fields` and of EVIDENCE added.

    `result(html, items, lines, scores)` gives the added columns; string columns
    named in `carry` are kept. Rows without html keep their place with nulls,
    for they may be the current ones.
    """
    own = [("page_id", pa.int64()), ("scraped_at", pa.timestamp("us", tz="UTC")), ("status", pa.string()), *[(c, pa.string()) for c in carry]]
    schema = pa.schema([pa.field(*f) for f in own] + list(fields) + list(EVIDENCE))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: dict[str, list] = {n: [] for n in names}
            told: list[tuple] = []
            for url, html, status in zip(*(batch.column(c).to_pylist() for c in ("url", "html", "status"))):
                if html is None:
                    told.append((None,) * len(EVIDENCE))
                    for n in names:
                        cols[n].append(None)
                    continue
                items = walk(html, url or "")
                lines = lines_of(items)
                scores = model.scores(lines)
                told.append(evidence_of(html, status, lines, scores))
                out = result(html, items, lines, scores)
                for n in names:
                    cols[n].append(out[n])
            arrays = [batch.column(n).cast(t) for n, t in own]
            arrays += [pa.array(cols[f.name], f.type) for f in fields]
            arrays += [pa.array([x[i] for x in told], f.type) for i, f in enumerate(EVIDENCE)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    ddl = "page_id bigint, scraped_at timestamp, status string" + "".join(f", {c} string" for c in carry) + _ddl_of(fields) + ", " + EVIDENCE_DDL
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("scraped_at").cast("timestamp"), "status", "url", "html")
    return rows.mapInArrow(run, ddl)


_DDL = {
    "int32": "int",
    "int64": "bigint",
    "string": "string",
    "bool": "boolean",
    "binary": "binary",
    "list<item: int32>": "array<int>",
    "list<item: int64>": "array<bigint>",
    "list<item: string>": "array<string>",
    "list<item: bool>": "array<boolean>",
}


def _ddl_of(fields: pa.Schema) -> str:
    return "".join(f", {f.name} {_DDL[str(f.type)]}" for f in fields)


def walked(
    pages: DataFrame, annotations: DataFrame, model: PageModel, fields: pa.Schema, result: Callable[[PageModel], Callable], carry: tuple[str, ...] = (), keep: bool = False
) -> DataFrame:
    """(page_id, scraped_at, status, *carry, *fields, evidence) of the current rows, whatever their status.

    `result(model)` gives the function for `map_pages`. What is not fitted yet
    in `model` is fitted, and stays in it for other queries. The html is walked
    once: the residue model is fitted on what the walk left of the current rows,
    which is kept for that; with `keep` it is kept in any case, for callers that
    read it more than once.
    """
    if not model.fitted:
        fit_body_model(pages, annotations, model=model)
    mapped = latest(map_pages(pages, model, fields, result(model), carry), "page_id", "scraped_at")
    if keep or not model.residue_fitted:
        use_checkpoints(pages.sparkSession)
        mapped = mapped.checkpoint()
    if not model.residue_fitted:
        model.residue = fit_residue(mapped)
        model.residue_fitted = True
    return mapped


def page_results(pages: DataFrame, annotations: DataFrame, model: PageModel | None, fields: pa.Schema, result: Callable[[PageModel], Callable], carry: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, scraped_at, status, *carry, *fields, residue): `walked` with the decision in place of the evidence."""
    model = model if model is not None else PageModel()
    return with_residue(walked(pages, annotations, model, fields, result, carry), model.residue)


def fit_page_model(pages: DataFrame, annotations: DataFrame, labelled: int = LABELLED) -> PageModel:
    """Both models, fitted ahead of the queries that share them."""
    use_checkpoints(pages.sparkSession)
    model = fit_body_model(pages, annotations, labelled)
    kept = latest(map_pages(pages, model, pa.schema([]), lambda *_: {}), "page_id", "scraped_at").checkpoint()
    model.residue, model.residue_fitted = fit_residue(kept), True
    return model

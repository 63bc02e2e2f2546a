"""Language ID by Bayesian evidence fusion.

For each page: posterior(l) ~ prior(l | host) * P(suffix | l) * P(declared | l) * P(text | l)

- text: hashed byte trigrams under smoothed multinomials, one per language, fitted on a
  bounded sample of labelled texts (``SAMPLE`` per language).  Trigrams of a
  text depend on each other, so n of them weigh as n / (1 + n / ``FULL``), in the fit too.
  A text of the sample is scored by the other texts alone.
- unknown: one more hypothesis with the prior ``UNKNOWN``, whose texts follow the better of two
  backgrounds: all buckets alike, or half that and half the mean of the languages.  Its
  probability is missing from the languages', so the confidence in a text of no known language is low.
- declared markup language and address suffix: how often each goes with each language,
  judged by the text alone, counted over the whole table and smoothed.
- host prior: counts of the same votes by host, smoothed towards those of the
  registered domain, those towards the whole table.  A page's own vote is left out.

All counts are grouped aggregations over one staged table of scores; tables by host, domain,
suffix and declared code grow with their distinct values and are joined, not broadcast by hint.

Defined results: NULL or empty text has no trigram and no vote: the other evidence decides; a
text for which unknown is better has no vote;
NULL host, suffix or declared code are values of their own; without any evidence the result is the
most frequent language; rows with the same id are judged one by one; an empty table gives an empty
one.  Without any labelled text there is no model: lang is NULL, confidence 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velostat.llm.common import LOWER, spark_schema, stage, text_blocks, text_key, unstage
from velostat.llm.repeats import pieces

BUCKETS = 1 << 14
SAMPLE = 400
FULL = 200
SMOOTHING = 0.5
PRIOR_WEIGHT = 5.0
MIN_CONFIDENCE = 0.5
UNKNOWN = 1e-3
UNIT = 1 << 20
FUSED_CELLS = 1 << 18  # rows x languages that are fused at once
SCORED_BYTES = 1 << 19  # of texts whose trigrams are held at once, in some 60 bytes of memory for each

# bytes that trigrams are made of: letters (A-Z lower-cased) and everything beyond ASCII
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_FOLD = np.where(_LETTER[LOWER], LOWER, np.uint8(32)).astype(np.uint8)


def _trigrams(block) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of the trigrams that hold a letter and stay inside one text."""
    x = _FOLD[block.data].astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)
    sizes = np.diff(np.append(block.starts, len(block.data)))
    owner = np.repeat(np.arange(len(block.starts)), sizes)[:-2]
    ok = (x[1:-1] != 32) & (np.arange(len(code)) + 3 <= block.ends[owner])
    return bucket[ok], owner[ok]


def _long_text_counts(block) -> np.ndarray | None:
    """Trigrams by bucket of a very long text, counted part by part; None for any other block."""
    parts = [part for _, part in pieces(block, 2)]
    if len(parts) == 1:
        return None
    return sum(np.bincount(_trigrams(part)[0], minlength=BUCKETS) for part in parts)


def _text_counts(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of the distinct trigram buckets of each text."""
    long = _long_text_counts(block)
    if long is not None:
        bucket = np.flatnonzero(long)
        return np.zeros(len(bucket), dtype=np.int64), bucket, long[bucket]
    bucket, owner = _trigrams(block)
    both, count = np.unique(owner * BUCKETS + bucket, return_counts=True)
    return both // BUCKETS, both % BUCKETS, count


def _units(owner: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Weights of the counts of texts, in whole units: n trigrams weigh as n / (1 + n / FULL)."""
    if not len(owner):
        return np.zeros(0, dtype=np.int64)
    total = np.bincount(owner, weights=count)
    return np.rint(count / (1 + total[owner] / FULL) * UNIT).astype(np.int64)


class Model(NamedTuple):
    """Languages, their trigram weights (languages x BUCKETS), and the languages whose sample holds a text, by its hash."""

    languages: list[str]
    counts: np.ndarray
    held: dict[int, list[int]]


def fit(texts: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model of (text, lang); None without any labelled text.

    Every language counts; of each the ``sample`` different texts with the smallest hash are used.
    The choice is made on a staged table of hashes, so that no text is moved but the chosen ones.
    The model holds BUCKETS numbers and ``sample`` hashes a language."""
    known = texts.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("place"))
    places = stage(known.select("lang", "place").distinct(), "language-places")
    sizes = places.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # few hashes of a large language are ranked: those below a bound that 4 * sample are expected under
    share = F.col("place") / F.lit(2.0**64) + 0.5
    # (one row a language is broadcast, as the model is, so that the hashes are not dealt by language for the join)
    near = places.join(F.broadcast(sizes), "lang").where(share * F.col("n") <= 4.0 * sample)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    # languages * sample rows at most
    picked = near.select("lang", "place", rank.alias("rank")).where(F.col("rank") <= sample).select("lang", "place").toArrow()
    languages = sorted(set(picked["lang"].to_pylist()))
    unstage(places)
    if not languages:
        return None
    known = known.join(F.broadcast(texts.sparkSession.createDataFrame(picked)), ["lang", "place"])
    rows = known.dropDuplicates(["lang", "place"])
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("units", pa.int64())])

    def run(batches):
        for batch in batches:
            lang = batch.column("lang")
            for block in text_blocks(batch.column("text"), SCORED_BYTES):
                owner, bucket, count = _text_counts(block)
                names = lang.take(pa.array(owner + block.first))
                yield pa.RecordBatch.from_arrays([names, pa.array(bucket), pa.array(_units(owner, count))], schema=schema)

    # languages x BUCKETS rows at most, of whole numbers: the order of the sums changes nothing
    sums = rows.select("lang", "text").mapInArrow(run, spark_schema(schema)).groupBy("lang", "bucket").agg(F.sum("units").alias("units"))
    found = sums.toArrow()
    counts = np.zeros((len(languages), BUCKETS))
    index = {x: i for i, x in enumerate(languages)}
    at = np.array([index[x] for x in found["lang"].to_pylist()], dtype=np.int64)
    counts[at, found["bucket"].to_numpy()] = found["units"].to_numpy() / UNIT
    held: dict[int, list[int]] = {}
    for lang, place in zip(picked["lang"].to_pylist(), picked["place"].to_pylist()):
        held.setdefault(place, []).append(index[lang])
    return Model(languages, counts, held)


def _log_table(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log-probabilities of some buckets: a row per language, then the pooled and the uniform background."""
    p = (counts + SMOOTHING) / (totals[:, None] + SMOOTHING * BUCKETS)
    even = np.full((1, p.shape[1]), 1 / BUCKETS)
    return np.log(np.concatenate([p, (p.mean(axis=0, keepdims=True) + even) / 2, even]))


_KEPT = ("id", "key", "host", "domain", "suffix", "declared")
_SCORES = pa.schema(
    [("id", pa.int64()), ("key", pa.int64())]
    + [(c, pa.string()) for c in _KEPT[2:]]
    + [("likelihood", pa.list_(pa.float64())), ("vote", pa.int32())]
)


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Batches of ``_SCORES`` for batches of (``_KEPT``, text, place)."""
    _, counts, held = model
    size, totals = len(counts), counts.sum(axis=1)
    logs = _log_table(counts, totals)
    for batch in batches:
        places = batch.column("place").to_numpy()
        for block in text_blocks(batch.column("text"), SCORED_BYTES):
            n = len(block.starts)
            long = _long_text_counts(block)
            if long is None:
                bucket, owner = _trigrams(block)
                count = np.bincount(owner, minlength=n)
                sums = np.stack([np.bincount(owner, weights=row[bucket], minlength=n) for row in logs], axis=1)
            else:
                count, sums = np.array([long.sum()]), (logs @ long)[None, :]
            for i, place in enumerate(places[block.first : block.last].tolist()):
                if place in held and count[i]:  # a text of the sample does not speak for itself
                    if long is None:
                        a, b = np.searchsorted(owner, [i, i + 1])
                        distinct, times = np.unique(bucket[a:b], return_counts=True)
                    else:
                        distinct, times = np.flatnonzero(long), long[long > 0]
                    own = _units(np.zeros(len(times), dtype=np.int64), times) / UNIT
                    rest, left = counts[:, distinct], totals.copy()
                    rest[held[place]] -= own
                    left[held[place]] -= own.sum()
                    sums[i] = _log_table(rest, left) @ times
            sums = sums / (1 + count / FULL)[:, None]
            unknown = sums[:, size:].max(axis=1) + np.log(UNKNOWN / (1 - UNKNOWN))
            sums = np.concatenate([sums[:, :size], unknown[:, None]], axis=1)
            best = sums.argmax(axis=1).astype(np.int32)
            rows_ = slice(block.first, block.last)
            cuts = np.arange(n + 1, dtype=np.int32) * (size + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c)[rows_] for c in _KEPT]
                + [pa.ListArray.from_arrays(cuts, pa.array(sums.ravel())), pa.array(best, mask=(count == 0) | (best == size))],
                schema=_SCORES,
            )
    pa.default_memory_pool().release_unused()  # the worker lives on: other tasks of the executor need the memory


def text_scores(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (id, key, text, host, domain, suffix, declared) with the text replaced by its
    log-likelihoods (the unknown hypothesis last, with its prior odds) and its vote (the index of the
    best language, NULL without trigrams or where unknown is better)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        yield from _scored(batches, shared.value)

    return rows.select(*_KEPT, "text", F.xxhash64("text").alias("place")).mapInArrow(run, spark_schema(_SCORES))


def _votes(scores: DataFrame, by: str) -> DataFrame:
    """(by, votes): the languages voted for and how often, by value of a column."""
    counts = scores.where("vote is not null").groupBy(F.col(by).alias(f"_{by}"), "vote").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return counts.groupBy(f"_{by}").agg(F.collect_list(F.struct("vote", "n")).alias(f"{by}_votes"))


def _dense(column: pa.Array, size: int) -> np.ndarray:
    """Lists of (vote, n) as a matrix (rows x languages)."""
    out = np.zeros((len(column), size))
    flat = column.flatten()
    row = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    out[row, flat.field("vote").to_numpy()] = flat.field("n").to_numpy()
    return out


def posteriors(likelihood: np.ndarray, vote: np.ndarray, whole: np.ndarray, votes: dict[str, np.ndarray]) -> np.ndarray:
    """Probabilities of each language and, last, of unknown; ``vote`` is -1 for none."""
    size = len(whole)
    own = vote[:, None] == np.arange(size)
    w = PRIOR_WEIGHT
    counts = {by: np.maximum(m - own, 0) for by, m in votes.items()}  # without the row's own vote
    every = np.maximum(whole[None, :] - own, 0)
    share = (every + 1) / (every.sum(axis=1, keepdims=True) + size)

    def smoothed(m: np.ndarray, towards: np.ndarray) -> np.ndarray:
        return (m + w * towards) / (m.sum(axis=1, keepdims=True) + w)

    prior = smoothed(counts["host"], smoothed(counts["domain"], share))
    # P(value | language) up to a common factor: P(language | value) / P(language), 1 for an unseen value
    seen = sum(np.log(smoothed(counts[by], share) / share) for by in ("suffix", "declared"))
    e = np.concatenate([np.log(prior) + likelihood[:, :size] + seen, likelihood[:, size:]], axis=1)
    p = np.exp(e - e.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fuse(scores: DataFrame, languages: list[str]) -> DataFrame:
    """(id, key, host, lang, confidence, text_lang) from the staged scores."""
    size, names = len(languages), pa.array(languages, type=pa.string())
    s, evidence = scores, ("host", "domain", "suffix", "declared")
    for by in evidence:
        s = s.join(_votes(scores, by), F.col(by).eqNullSafe(F.col(f"_{by}")), "left").drop(f"_{by}")
    whole = np.zeros(size)
    for vote, n in scores.where("vote is not null").groupBy("vote").count().collect():  # a row per language
        whole[vote] = n
    schema = pa.schema(
        [("id", pa.int64()), ("key", pa.int64()), ("host", pa.string()), ("lang", pa.string()), ("confidence", pa.float64()), ("text_lang", pa.string())]
    )
    step = max(1, FUSED_CELLS // size)

    def run(batches):
        for whole_batch in batches:
            for a in range(0, whole_batch.num_rows, step):
                batch = whole_batch.slice(a, step)
                likelihood = batch.column("likelihood").flatten().to_numpy().reshape(-1, size + 1)
                vote = batch.column("vote")
                votes = {by: _dense(batch.column(f"{by}_votes"), size) for by in evidence}
                p = posteriors(likelihood, vote.fill_null(-1).to_numpy(), whole, votes)[:, :size]
                columns = [batch.column(c) for c in ("id", "key", "host")]
                columns += [names.take(pa.array(p.argmax(axis=1))), pa.array(p.max(axis=1)), names.take(vote)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return s.select("id", "key", "host", "likelihood", "vote", *[f"{by}_votes" for by in evidence]).mapInArrow(run, spark_schema(schema))


def identify(rows: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(id, key, host, lang, confidence, text_lang) for rows (id, key, text, host, domain, suffix, declared)."""
    model = fit(labelled, sample)
    if model is None:
        empty = F.lit(None).cast("string")
        return rows.select("id", "key", "host", empty.alias("lang"), F.lit(0.0).alias("confidence"), empty.alias("text_lang"))
    return fuse(stage(text_scores(rows, model), "language-scores"), model.languages)


def page_rows(pages: DataFrame) -> DataFrame:
    """Evidence of web pages (page_id, url, html)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    authority = F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    host = F.lower(F.nullif(authority, F.lit("")))
    return pages.select(
        F.col("page_id").cast("bigint").alias("id"), html.alias("_html"), text.alias("text"), host.alias("host")
    ).select(
        "id",
        text_key(F.col("id"), F.col("_html")).alias("key"),
        "text",
        "host",
        F.nullif(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"),
        F.nullif(F.regexp_extract("host", r"\.([^.]+)$", 1), F.lit("")).alias("suffix"),
        F.lower(F.nullif(F.regexp_extract("_html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1), F.lit(""))).alias("declared"),
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """Evidence of documents (doc_id, text, lang, source): the source stands for the host."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("id"),
        text_key(F.col("doc_id").cast("bigint"), text).alias("key"),
        text.alias("text"),
        F.col("source").cast("string").alias("host"),
        none.alias("domain"),
        none.alias("suffix"),
        F.lower(F.col("lang").cast("string")).alias("declared"),
    )


def drop_unidentified(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The rows of ``docs`` whose language is known: a text without any letter goes, and one whose
    best language is less likely than ``min_confidence``.

    A document's own label is no evidence for keeping it.  Labels of one language (pt, pt-BR) count as one, so
    that a text does not go because it could have either.  Without any label there is no model and
    every text with a letter stays."""
    label = F.lower(F.regexp_extract(F.col("lang").cast("string"), r"^\s*([^\s_-]*)", 1))
    labelled = docs.select(F.col("text").cast("string").alias("text"), F.nullif(label, F.lit("")).alias("lang"))
    found = identify(document_rows(docs).withColumn("declared", F.lit(None).cast("string")), labelled)
    # lang is NULL without any model: no decision
    bad = found.where(F.col("lang").isNotNull() & (F.col("confidence") < min_confidence)).select(F.col("id").alias("_id"), F.col("key").alias("_key")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.where(text.rlike(r"\p{L}"))
    rows = rows.select(F.struct("*").alias("_row"), text_key(F.col("doc_id").cast("bigint"), text).alias("_k"))
    clean = rows.join(bad, (F.col("_k") == F.col("_key")) & F.col("_row.doc_id").eqNullSafe(F.col("_id")), "left_anti")
    return clean.select("_row.*")

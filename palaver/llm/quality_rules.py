"""Quality rules: base rules on words, then perplexity bands by language.

Base rules need one look at a text: few words, or many words inside repeated
five-word windows.  The method's verdict comes from an n-gram model per language
with modified Kneser-Ney smoothing over the texts' UTF-16 code units: Spark
counts the n-grams and estimates their probabilities, and documents whose bits
per unit lie outside their language's band are rejected, too predictable as
well as too surprising.

Four units of 16 bits are one 64-bit number, so an n-gram is its own exact key in
every script; context and suffix are its leading and trailing bits, and the whole
estimate is a few aggregates and joins by these numbers.  The model is of the
documents themselves, all of them and whole texts, so each of their n-grams is
in it.

Scoring reads probabilities from arrays sorted by n-gram.  A model of at most
``broadcast_mb`` is sent to every task.  A larger one is never in one place:
documents are dealt by hash into parts of about ``part_bytes``, the distinct
n-grams of a part are joined to the model's table by hash, and a part's sorted
arrays meet its documents in a cogroup.  Both ways give the same scores.

Bands: median bits per unit +- ``width`` robust deviations (interquartile
range / 1.349), widened for short texts by sqrt(1 + short / units).

Defined results: a null or empty text has no words and fails the base rules; a
null language is a language of its own; a language with few documents is judged
by these alone; rows are judged one by one, so repeated rows and ties agree; an
empty table gives an empty result; ``quality_filter`` keeps all columns,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.blocks import SPACE, Block, blocks, closed, mix, opened, saved

ORDER = 4
BITS = 16
#: Units that any context may go on with: the lowest order backs off to all of them alike.
SYMBOLS = 1 << BITS
BASE_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b"#*$%&|<>")] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point
#: Discounts where a language has too few n-grams to estimate them.
_PLAIN = (0.5, 0.75, 0.9)
_ROW_BYTES = 12


def base_counts(b: Block) -> dict[str, np.ndarray]:
    """The base counts of each text of a block."""
    begin, end, doc = b.words()
    ink = ~SPACE[b.data]
    out = {"n_words": np.bincount(doc, minlength=b.n)}
    out["word_chars"] = b.per_text(ink & _LEAD[b.data])
    out["n_symbols"] = b.per_text(_MARKS[b.data])
    # Lines: cut at \n and at the ends of texts.
    cuts = np.flatnonzero(b.data == 10)
    first = np.sort(np.concatenate([b.starts[:-1], cuts + 1]))
    owner = np.searchsorted(b.starts[1:], first, side="right")
    spare = first >= len(b.data)  # begins of empty texts at the very end
    first, owner = first[~spare], owner[~spare]
    stop = np.minimum(np.concatenate([first[1:], [len(b.data)]]), len(b.data))
    ends_in_break = (stop > first) & (b.data[np.maximum(stop - 1, 0)] == 10)
    stop = stop - ends_in_break
    total = np.concatenate([[0], np.cumsum(ink)])
    worded = total[stop] > total[first]
    key = mix(b.hashes(first[worded], stop[worded]) ^ mix(owner[worded].astype(np.uint64)))
    distinct, at = np.unique(key, return_index=True)
    lines = np.bincount(owner[worded], minlength=b.n)
    out["n_dup_lines"] = lines - np.bincount(owner[worded][at], minlength=b.n)
    # Five-word windows found twice or more in one text.
    covered = np.zeros(b.n, dtype=np.int64)
    if len(doc) >= 5:
        w = b.hashes(begin, end)
        own = np.flatnonzero(doc[4:] == doc[:-4])
        h = mix(doc[own].astype(np.uint64))
        for j in range(5):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[own + j])
        order = np.argsort(h)
        s = h[order]
        same = s[1:] == s[:-1]
        again = np.zeros(len(s), dtype=bool)
        again[1:] |= same
        again[:-1] |= same
        at = own[order[again]]
        hit = np.zeros(len(doc) + 5, dtype=np.int64)
        np.add.at(hit, at, 1)
        np.add.at(hit, at + 5, -1)
        covered = np.bincount(doc[np.cumsum(hit)[: len(doc)] > 0], minlength=b.n)
    out["n_repeat_words"] = covered
    return out


def units(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """UTF-16 code units of a block, and their number in each text."""
    n = b.per_text(_LEAD[b.data]) + b.per_text(b.data >= 0xF0)
    data = b.data.tobytes().decode("utf-8", "replace").encode("utf-16-le")
    if len(data) != 2 * n.sum():  # not UTF-8: text by text, as errors are replaced by fewer or more units
        parts = [b.text(i).decode("utf-8", "replace").encode("utf-16-le") for i in range(b.n)]
        data, n = b"".join(parts), np.array([len(x) // 2 for x in parts])
    return np.frombuffer(data, "<u2").astype(np.uint64), n


def ngrams(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each unit of a block, as int64, and units per text; texts begin with padding."""
    unit, n = units(b)
    place = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n)
    code = unit.copy()
    for j in range(1, ORDER):
        before = np.zeros_like(unit)
        before[j:] = unit[:-j]
        before[place < j] = 0
        code |= before << np.uint64(BITS * j)
    return code.view(np.int64), n


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, n = np.concatenate([c for c, _ in parts]), np.concatenate([k for _, k in parts])
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(n, first)


def _counted(group: str | None):
    """Counts of a task's n-grams by language (and ``group``), merged before they leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size: dict[tuple, int] = {}
        for batch in batches:
            own = list(zip(batch[group].to_pylist() if group else [0] * batch.num_rows, batch["band"].to_pylist(), strict=True))
            for b in blocks(batch["text"]):
                code, n = ngrams(b)
                here = own[b.rows]
                for key in set(here):
                    at = np.repeat([x == key for x in here], n) if len(set(here)) > 1 else slice(None)
                    found, k = np.unique(code[at], return_counts=True)
                    if len(found):
                        held.setdefault(key, []).append((found, k))
                        size[key] = size.get(key, 0) + len(found)
                    if size.get(key, 0) > 1_000_000:
                        held[key] = [_merged(held[key])]
                        size[key] = 0
        for (part, band), tables in held.items():
            codes, n = _merged(tables)
            for a in range(0, len(codes), 100_000):
                own_codes = codes[a : a + 100_000]
                yield pa.record_batch(
                    [pa.array(np.full(len(own_codes), part, dtype=np.int32)), pa.array([band] * len(own_codes), pa.string()), pa.array(own_codes), pa.array(n[a : a + 100_000])], names=["part", "band", "gram", "n"]
                )

    return run


def ngram_counts(slim: DataFrame) -> DataFrame:
    """band, gram, n over all documents; tasks pre-aggregate, then a partial aggregate by key."""
    return slim.mapInArrow(_counted(None), "part int, band string, gram long, n long").groupBy("band", "gram").agg(F.sum("n").alias("n"))


def _discounts(table: DataFrame) -> DataFrame:
    """band, d1, d2, d3: what is taken off counts of one, two, three and more."""
    n = [F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)]
    each = table.groupBy("band").agg(*n)
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    some = F.least("n1", "n2", "n3", "n4") > 0
    made = []
    for i, plain in zip((1, 2, 3), _PLAIN, strict=True):
        own = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        made.append(F.when(some, F.least(F.greatest(own, F.lit(0.05)), F.lit(float(i)))).otherwise(F.lit(plain)).alias(f"d{i}"))
    return each.select("band", *made)


def kneser_ney(counts: DataFrame) -> DataFrame:
    """band, gram, p: the probability of each n-gram's last unit after the others.

    A lower order counts the distinct units seen to the left of its n-grams.
    """
    levels = [counts]
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (BITS * k)) - 1)).alias("gram")
        levels.append(levels[-1].select("band", shorter).groupBy("band", "gram").agg(F.count("*").alias("n")))
    lower = None
    for k, table in enumerate(reversed(levels), 1):
        discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        head = F.shiftrightunsigned("gram", BITS)
        own = table.join(_discounts(table), "band").select("band", "gram", "n", discount.alias("d"), head.alias("head"))
        heads = own.groupBy("band", "head").agg(F.sum("n").alias("total"), F.sum("d").alias("taken"))
        own = own.join(heads, ["band", "head"])
        kept, left = (F.col("n") - F.col("d")) / F.col("total"), F.col("taken") / F.col("total")
        if lower is None:
            lower = own.select("band", "gram", (kept + left / SYMBOLS).alias("p"))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1))
            own = own.select("band", "gram", suffix.alias("suffix"), kept.alias("kept"), left.alias("left"))
            lower = own.join(lower.select("band", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["band", "suffix"])
            lower = lower.select("band", "gram", (F.col("kept") + F.col("left") * F.col("below")).alias("p"))
    return lower


def _arrays(table: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each band the n-grams, sorted, and their bits."""
    if not table.num_rows:
        return {}
    bands = table["band"].combine_chunks().dictionary_encode()
    of, gram, bits = bands.indices.to_numpy(), table["gram"].to_numpy(), table["bits"].to_numpy()
    order = np.lexsort((gram, of))
    ends = np.cumsum(np.bincount(of, minlength=len(bands.dictionary)))
    return {name: (gram[order[e - k : e]], bits[order[e - k : e]]) for name, e, k in zip(bands.dictionary.to_pylist(), ends.tolist(), np.diff(ends, prepend=0).tolist(), strict=True)}


def _score_batch(batch, arrays: dict, columns: list[str]) -> pa.RecordBatch:
    out = {f: np.zeros(batch.num_rows, dtype=np.int64) for f in (*BASE_FIELDS, "n_units")}
    bits = np.zeros(batch.num_rows)
    bands = batch["band"].to_pylist()
    for b in blocks(batch["text"]):
        for f, x in base_counts(b).items():
            out[f][b.rows] = x
        code, n = ngrams(b)
        out["n_units"][b.rows] = n
        own = bands[b.rows]
        cost = np.zeros(len(code))
        for band in set(own):
            at = np.flatnonzero(np.repeat([x == band for x in own], n))
            if len(at):
                grams, values = arrays[band]
                cost[at] = values[np.searchsorted(grams, code[at])]
        total = np.concatenate([[0.0], np.cumsum(cost)])
        ends = np.cumsum(n)
        bits[b.rows] = (total[ends] - total[ends - n]) / np.maximum(n, 1)
    return pa.record_batch([*(batch[c].combine_chunks() if isinstance(batch, pa.Table) else batch[c] for c in columns), *(pa.array(x) for x in out.values()), pa.array(bits)], names=[*columns, *out, "bits"])


def score(docs: DataFrame, broadcast_mb: int = 64, part_bytes: int = 24 << 20) -> DataFrame:
    """doc_id and text_id with the base counts, n_units, band (its language) and bits per unit."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    band = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    slim = docs.select("doc_id", F.xxhash64(text).alias("text_id"), F.col("lang").cast("string").alias("lang"), band.alias("band"), text.alias("text"))
    counts = saved(ngram_counts(slim), "quality-ngrams")
    model = kneser_ney(counts).select("band", "gram", (-F.log2("p")).cast("float").alias("bits"))
    columns = ["doc_id", "text_id", "lang", "band"]
    kind = slim.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, text_id long, lang string, band string, " + ", ".join(f"{f} long" for f in (*BASE_FIELDS, "n_units")) + ", bits double"
    if counts.count() * _ROW_BYTES <= broadcast_mb << 20:
        shared = spark.sparkContext.broadcast(_arrays(model.toArrow()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _score_batch(batch, shared.value, columns)

        return slim.mapInArrow(run, fields)
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(1, -(-size // part_bytes))
    dealt = slim.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_id"), F.lit(n_parts)).cast("int"))
    needed = dealt.repartition(n_parts, "part").mapInArrow(_counted("part"), "part int, band string, gram long, n long")
    needed = needed.select("part", "band", "gram").join(model, ["band", "gram"])

    def together(own: pa.Table, table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_score_batch(own, _arrays(table), columns)])

    return dealt.groupBy("part").cogroup(needed.groupBy("part")).applyInArrow(together, fields)


def judge(docs: DataFrame, width: float = 6.0, short: float = 400.0, least_words: int = 10, repeat_percent: int = 20, **options) -> DataFrame:
    """The scores with base_failed, the language's band (low, high) and kept."""
    scored = saved(score(opened(docs, "doc_id", "text", "lang")[0], **options), "quality-scores")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    q = F.percentile_approx("bits", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000)
    bands = scored.filter("not base_failed").groupBy("band").agg(q.alias("q"))
    bands = bands.select("band", F.col("q")[1].alias("middle"), F.greatest((F.col("q")[2] - F.col("q")[0]) / 1.349, F.lit(0.02)).alias("spread"))
    out = scored.join(bands, "band", "left")
    reach = F.lit(width) * F.col("spread") * F.sqrt(1 + F.lit(short) / F.greatest("n_units", F.lit(1)))
    out = out.withColumn("low", F.col("middle") - reach).withColumn("high", F.col("middle") + reach)
    return out.withColumn("kept", ~F.col("base_failed") & F.col("bits").between(F.col("low"), F.col("high"))).drop("middle", "spread")


def quality_filter(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with all their columns."""
    docs, names = opened(docs, "doc_id", "text", "lang")
    kept = judge(docs, **options).filter("kept").select(F.col("doc_id").alias("kept_doc"), F.col("text_id").alias("kept_text"), F.col("lang").alias("kept_lang")).dropDuplicates()
    same = docs["doc_id"].eqNullSafe(F.col("kept_doc")) & (F.xxhash64(docs["text"].cast("string")) == F.col("kept_text")) & docs["lang"].cast("string").eqNullSafe(F.col("kept_lang"))
    return closed(docs.join(kept, same, "left_semi"), names)

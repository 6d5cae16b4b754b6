"""Toxicity by class-conditional Kneser-Ney models over the spelling of words.

Two models, toxic and ordinary, give each character of a word a probability after the (up to) five before it. Both
discount their own counts and back off to one shared model: counts over the words of all documents, with Kneser-Ney
continuation counts below. A gram that neither class has seen differs by the two back-off weights of its context alone. A
word's evidence is the difference of its two log-likelihoods; a text is judged by the best mean over ``SPAN`` neighbouring
words and by the mean over all its words (both length-normalised), which a logistic curve turns into a score.

Counting: a task counts its documents' words (once for each document), and cuts them into grams, ``FLUSH`` words at a
time. The gram counts are shuffled once, by the three characters before the last: that decides the gram's context, its
lower order and that one's context, so that all sums are windows of the same shuffle. Labels come in by a broadcast of at
most about ``MAX_PER_CLASS`` labelled rows of each class, chosen by hash (the documented bound of the training sample).
The curve is fitted on that sample, each half scored by the model of the other half.

Scoring: every gram's evidence and every context's weight goes to a stored table in blocks of about ``BLOCK`` entries. A task
gathers the new words of a slice of texts and asks one block after the other; a worker keeps up to ``KEPT`` entries in
memory and reads the other blocks again. Texts are read where they lie and never shuffled.

Defined results: a null or wordless text has no evidence and gets the curve's value there; rows labelled twice count
as toxic if any label says so; without labels of both classes every score is 0; repeated rows are scored one by one;
an empty table gives an empty result; extra columns pass, a clashing one is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlens.llm.common import filesystem, held, lower_ascii, mapped, mixed, others, quoted, register, released, slices, stored, table, texts_of, unwrapped, wrapped
from hitlens.llm.suffix_decontamination import words_of

ORDER = 6
LOWER = 4  # order of the shared continuation counts
SPAN = 4
DISCOUNTS = (1.0, 1.5, 1.5)  # of counts 1, 2 and above: what one document alone says is left to the shared counts
STRENGTH = 30.0  # weight of the shared model in a context without own counts
MAX_PER_CLASS = 50_000
BLOCK = 1 << 20  # entries of a block of evidence
KEPT = 1 << 22  # entries a worker keeps in memory
FLUSH = 150_000  # distinct words a task counts before it cuts them into grams
BUCKETS = 1 << 14
CONTEXT = np.uint64(0x5BD1E9955BD1E995)  # sets the hash of a context apart from that of an equal gram
THRESHOLD = 0.7
CACHE = 150_000
HALVES = ("all", "first", "second")
COUNTS = ["n", "t0", "t1", "o0", "o1"]
GRAMS = "bucket int, gram string, " + ", ".join(f"{c} long" for c in COUNTS)
VARIANTS = {"all": ("t0 + t1", "o0 + o1"), "first": ("t0", "o0"), "second": ("t1", "o1")}


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_sample(labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """``doc_id, toxic, half``: a hash sample of the labelled rows, of about ``max_per_class`` rows of a class at most."""
    rows = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = rows.filter(~held_out(F.col("doc_id")))
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, max_per_class / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id")), F.lit(2)).cast("int")
    return rows.filter(drawn).select(F.col("doc_id").alias("labelled"), "toxic", half.alias("half"))


def vocabulary(docs: DataFrame, sample: DataFrame, text: str) -> DataFrame:
    """Per word of all documents: documents with it, and labelled ones by class (t, o) and half (0, 1)."""
    plain = F.btrim(F.regexp_replace(lower_ascii(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), F.lit(" "))
    joined = docs.select("doc_id", plain.alias("plain")).join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"), "left")
    words = joined.select(F.explode(F.array_distinct(F.split("plain", " "))).alias("word"), "toxic", "half").filter("word <> ''")

    def documents(toxic: int, half: int) -> Column:
        return F.count(F.when((F.col("toxic") == toxic) & (F.col("half") == half), 1))

    return words.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), documents(1, 0).alias("t0"), documents(1, 1).alias("t1"), documents(0, 0).alias("o0"), documents(0, 1).alias("o1")
    )


def pieces(word: str, order: int = ORDER) -> list[str]:
    """The grams of a word with its ends: one for each character, with up to ``order - 1`` before it."""
    padded = f"\x02{word}\x03"
    return [padded[max(0, i - order) : i] for i in range(2, len(padded) + 1)]


def cut(words: Iterable[Mapping[str, int]], order: int, lower: int) -> Iterator[pa.RecordBatch]:
    """Gram counts from word counts: of all documents, and of the labelled ones by class and half."""
    sums: list[dict[str, int]] = []
    for counts in words:
        found: dict[str, int] = {}
        get = found.get
        for word, n in counts.items():
            for gram in pieces(word, order):
                found[gram] = get(gram, 0) + n
        sums.append(found)
    names = list(sums[0])
    for start in range(0, len(names), 1 << 16):
        part = names[start : start + (1 << 16)]
        buckets = np.fromiter((crc32(g[-lower:-1].encode()) % BUCKETS for g in part), dtype=np.int32, count=len(part))
        columns = [np.fromiter((found.get(g, 0) for g in part), dtype=np.int64, count=len(part)) for found in sums]
        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(part, pa.string()), *map(pa.array, columns)], ["bucket", "gram", *COUNTS])


def grams(words: DataFrame, order: int = ORDER, lower: int = LOWER) -> DataFrame:
    """Gram counts of a table of words with their counts, as each task has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "word", 1 << 20):
            names, counts = part.column("word").to_pylist(), [Counter() for _ in COUNTS]
            for into, c in zip(counts, COUNTS, strict=True):
                into.update({w: k for w, k in zip(names, part.column(c).to_pylist(), strict=True) if k})
            yield from cut(counts, order, lower)

    return mapped(words.select("word", *COUNTS), run, GRAMS)


def text_grams(docs: DataFrame, sample: DataFrame, text: str, order: int = ORDER, lower: int = LOWER) -> DataFrame:
    """Gram counts of the words of all documents, as each task has them."""
    joined = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"), "left")
    side = F.when(F.col("toxic") == 1, F.lit(1) + F.col("half")).when(F.col("toxic") == 0, F.lit(3) + F.col("half")).otherwise(F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(("counts",), dict)  # lets go what another operator has left in this worker
        counts = [Counter() for _ in COUNTS]

        def flushed() -> Iterator[pa.RecordBatch]:
            yield from cut([{w.decode(): k for w, k in c.items()} for c in counts], order, lower)
            for c in counts:
                c.clear()

        for part in slices(batches, "text", 1 << 20):
            for words, label in zip(map(words_of, texts_of(part.column("text"))), part.column("side").to_pylist(), strict=True):
                distinct = set(words)
                counts[0].update(distinct)
                if label:
                    counts[label].update(distinct)
            if len(counts[0]) > FLUSH:
                yield from flushed()
        yield from flushed()

    return mapped(joined.select("text", side.alias("side")), run, GRAMS)


def _discount(count: Column) -> Column:
    return F.when(count <= 0, 0.0).when(count == 1, DISCOUNTS[0]).when(count == 2, DISCOUNTS[1]).otherwise(DISCOUNTS[2])


def modelled(counts: DataFrame, lower: int = LOWER) -> DataFrame:
    """A stored row for each gram that a class has seen, with all that its models need but the character's share.

    Also kept is the first gram of each context that a class knows (``heads_context``), which stands for the context, and of each lower order
    (``heads_low``), with the number of its grams (``c``).
    """
    rows = counts.repartition("bucket").groupBy("bucket", "gram").agg(*[F.sum(c).alias(c) for c in COUNTS])
    n = F.char_length("gram")
    rows = rows.select(
        "*", F.expr("left(gram, char_length(gram) - 1)").alias("context"), F.expr("right(gram, 1)").alias("char"),
        F.substring("gram", F.greatest(n - lower + 1, F.lit(1)), F.least(n, F.lit(lower)) - 1).alias("low_context"),
    )
    low = Window.partitionBy("bucket", "low_context", "char")
    base = Window.partitionBy("bucket", "low_context")
    rows = rows.withColumns({"c": F.count(F.lit(1)).over(low), "heads_low": F.row_number().over(low.orderBy("gram")) == 1})
    rows = rows.withColumns({"cc": F.count(F.lit(1)).over(base), "ct": F.sum(F.col("heads_low").cast("int")).over(base)})
    context = Window.partitionBy("bucket", "low_context", "context")
    sums = {"all_n": F.sum("n").over(context), "all_t": F.count(F.lit(1)).over(context), "heads_context": F.row_number().over(context.orderBy("char")) == 1}
    for name, pair in VARIANTS.items():
        for side, count in zip("to", pair, strict=True):
            sums |= {f"{side}_{name}_n": F.sum(F.expr(count)).over(context), f"{side}_{name}_d": F.sum(_discount(F.expr(count))).over(context)}
    rows = rows.withColumns(sums)
    seen = F.expr("t0 + t1 + o0 + o1 > 0")
    known = F.col("t_all_n") + F.col("o_all_n") > 0
    masses = [c for c in sums if c[1] == "_"]
    kept = rows.withColumns({"seen": seen, "heads_context": F.col("heads_context") & known}).filter("seen or heads_low or heads_context")
    # shared order: n and all_n decide it, and what is left goes to the lower order and the character's share
    return stored(
        kept.select(
            "gram", "context", "char", "seen", "heads_low", "heads_context", F.when(F.col("heads_low"), F.col("c")).alias("c"), *COUNTS[1:],
            ((F.col("n") - 0.75) / F.col("all_n") + 0.75 * F.col("all_t") / F.col("all_n") * (F.col("c") - 0.75) / F.col("cc")).alias("fixed"),
            (0.75 * F.col("all_t") / F.col("all_n") * 0.75 * F.col("ct") / F.col("cc")).alias("share"), *masses,
        ),
        "models",
    )


def log_ratios(rows: DataFrame) -> DataFrame:
    """Per gram that a class has seen: log-likelihood difference under the models of all labels and of each half."""
    single = rows.filter("heads_low").groupBy(F.col("char").alias("of_char")).agg(F.sum("c").alias("c1"))
    total = single.agg(F.sum("c1")).first()[0] or 1
    joined = rows.filter("seen").join(single, F.col("char") == F.col("of_char"))
    pool = F.col("fixed") + F.col("share") * F.col("c1") / F.lit(total)

    def model(name: str, side: str) -> Column:
        c = F.expr(VARIANTS[name]["to".index(side)])
        return (c - _discount(c) + (F.col(f"{side}_{name}_d") + STRENGTH) * pool) / (F.col(f"{side}_{name}_n") + STRENGTH)

    return joined.select("gram", *[(F.log(model(name, "t")) - F.log(model(name, "o"))).alias(name) for name in HALVES])


def backoffs(rows: DataFrame) -> DataFrame:
    """Per context that a class knows: the log ratio of the two models' back-off weights, for what neither has seen there."""

    def weight(name: str, side: str) -> Column:
        return F.log((F.col(f"{side}_{name}_d") + STRENGTH) / (F.col(f"{side}_{name}_n") + STRENGTH))

    return rows.filter("heads_context").select("context", *[(weight(name, "t") - weight(name, "o")).alias(name) for name in HALVES])


def evidence(words: DataFrame, order: int = ORDER, lower: int = LOWER) -> DataFrame:
    """Per gram that a class has seen, from a table of words: its log-likelihood difference."""
    return log_ratios(modelled(grams(words, order, lower), lower))


def in_blocks(found: DataFrame, block: int = BLOCK) -> list[str]:
    """Store ``key`` and values in blocks by hash; returns the files, one for each block."""
    found = stored(found, "evidence")
    made = stored(found.repartition(found.count() // block + 1, "key"), "blocks")
    released(found)
    return sorted(made.inputFiles())


def _states(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per character of the texts, end to end: hashes of the (up to) ``order`` characters up to it and of those but the last,
    and the first and last place of its text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(lengths)
    at, first = np.arange(len(codes)), np.repeat(ends - lengths, lengths)
    state = before = np.zeros(len(codes), dtype=np.uint64)
    for k in range(order - 1, -1, -1):
        before = state
        inside = np.flatnonzero(at - k >= first)
        state = state.copy()
        state[inside] = mixed(state[inside] * np.uint64(0x9E3779B97F4A7C15) + codes[inside - k])
    return state, before, first, ends - 1


def keyed(found: DataFrame, backoff: DataFrame | None = None, order: int = ORDER) -> DataFrame:
    """The values of grams, and of contexts, by hash."""
    rows = found.select("gram", F.lit(0).alias("context"), *HALVES)
    if backoff is not None:
        rows = rows.union(backoff.select("context", F.lit(1), *HALVES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "gram", 1 << 20):
            state, _, _, ends = _states(part.column("gram").to_pylist(), order)
            keys = np.where(part.column("context").to_numpy() == 1, state[ends] ^ CONTEXT, state[ends])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *[part.column(n) for n in HALVES]], ["key", *HALVES])

    return mapped(rows, run, "key long, " + ", ".join(f"{n} double" for n in HALVES))


class Evidence:
    """Sums of the evidence of words, asked from blocks in the shared folder, with a bounded cache of words."""

    def __init__(self, files: list[str], order: int = ORDER, kept: int = KEPT) -> None:
        self.files, self.order, self.kept = files, order, kept
        self.blocks: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.known: dict[bytes, int] = {}
        self.values = np.zeros((0, len(HALVES)))

    def read(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for file in self.files:
            block = self.blocks.get(file)
            if block is None:
                fs, path = filesystem(file)
                data = pq.read_table(path, filesystem=fs)
                keys = data.column("key").to_numpy().view(np.uint64)
                order = np.argsort(keys)
                block = keys[order], np.column_stack([data.column(n).to_numpy() for n in HALVES]).astype(np.float64)[order]
                if sum(len(k) for k, _ in self.blocks.values()) + len(keys) <= self.kept:
                    self.blocks[file] = block
            yield block

    def ask(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of hashes, and which of them there are."""
        out, there = np.zeros((len(asked), len(HALVES))), np.zeros(len(asked), dtype=bool)
        for keys, values in self.read():
            if len(keys):
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                here = keys[at] == asked
                out[here], there[here] = values[at[here]], True
        return out, there

    def sums(self, words: list[bytes]) -> np.ndarray:
        """One row of summed evidence for each word."""
        padded = [f"\x02{w.decode()}\x03" for w in words]
        state, before, first, ends = _states(padded, self.order)
        grams = np.flatnonzero(np.arange(len(state)) > first)  # one for each character but the mark before the word
        values, there = self.ask(state[grams])
        rest = np.flatnonzero(~there)
        values[rest] = self.ask(before[grams[rest]] ^ CONTEXT)[0]
        starts = np.concatenate([[0], ends[:-1] + 1]) - np.arange(len(words))
        return np.add.reduceat(values, starts, axis=0)

    def learn(self, words: set[bytes]) -> None:
        """Make the sums of these words known; others may be forgotten for it."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE:  # keep what these texts need
            old = [w for w in words if w in self.known]
            self.values = self.values[[self.known[w] for w in old]]
            self.known = dict(zip(old, range(len(old)), strict=True))
        for start in range(0, len(new), 1 << 16):
            part = new[start : start + (1 << 16)]
            self.known.update(zip(part, range(len(self.values), len(self.values) + len(part)), strict=True))
            self.values = np.vstack([self.values, self.sums(part)])

    def scores(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Per text a row of sums for each word."""
        cut_ = [words_of(t) for t in texts]
        self.learn({w for words in cut_ for w in words})
        for words in cut_:
            yield self.values[np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))]


def word_scores(words: DataFrame, found: DataFrame, order: int = ORDER, block: int = BLOCK) -> DataFrame:
    """``word``, its number of documents ``n``, and the summed evidence of its grams under each model."""
    files = in_blocks(keyed(found), block)
    schema = "word string, n long, " + ", ".join(f"{name} double" for name in HALVES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(("evidence", *files), lambda: Evidence(files, order))
        for part in slices(batches, "word", 1 << 16):
            values = known.sums(texts_of(part.column("word")))
            yield pa.RecordBatch.from_arrays([part.column("word"), part.column("n"), *map(pa.array, np.ascontiguousarray(values.T))], ["word", "n", *HALVES])

    return mapped(words.select("word", "n"), run, schema)


def features(x: np.ndarray) -> list[float]:
    """For each model the best mean over neighbouring words and the mean over all words."""
    if not len(x):
        return [0.0] * (2 * x.shape[1])
    n = min(SPAN, len(x))
    sums = np.cumsum(np.vstack([np.zeros(x.shape[1]), x]), axis=0)
    return np.column_stack([(sums[n:] - sums[:-n]).max(axis=0) / n, sums[-1] / len(x)]).ravel().tolist()


def _features(docs: DataFrame, files: list[str], names: list[str], text: str, into: list[str], carried: list[str], kept: int) -> DataFrame:
    """The carried columns and, for each named model, the two features of the texts."""
    schema = T.StructType([*[docs.schema[c] for c in carried], *[T.StructField(c, T.DoubleType()) for c in into]])
    columns = [HALVES.index(n) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(("evidence", *files), lambda: Evidence(files, kept=kept))
        for part in slices(batches, text, 1 << 20):
            rows = [features(x[:, columns]) for x in known.scores(texts_of(part.column(text)))]
            out = [pa.array(c, pa.float64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carried], *out], schema.names)

    return mapped(docs, run, schema)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", max_per_class: int = MAX_PER_CLASS, carry_text: bool = False, most: int = KEPT) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (score at least 0.7), learnt from ``labels``."""
    produced = ["score", "predicted"]
    source = docs.select(*others(docs, [*produced, text]), F.col(text).cast("string").alias(text))
    carried = [c for c in source.columns if carry_text or c != text]
    sample = stored(training_sample(labels, max_per_class), "sample")
    models = modelled(text_grams(source, sample, text))
    files = in_blocks(keyed(log_ratios(models), backoffs(models)))
    released(models)
    labelled = source.select("doc_id", F.col(text).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("labelled")).select("toxic", "half", "text")
    rows = _features(labelled, files, list(HALVES[1:]), "text", ["a0", "b0", "a1", "b1"], ["toxic", "half"], most)
    data = rows.toArrow()  # the training sample: four numbers for each row
    toxic, half = data.column("toxic").to_numpy(), data.column("half").to_numpy()
    if len(set(toxic.tolist())) < 2:
        return source.select(*quoted(carried), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    other = [np.where(half == 0, data.column(f"{c}1").to_numpy(), data.column(f"{c}0").to_numpy()) for c in "ab"]
    w = logistic(np.column_stack(other), toxic.astype(float))
    made = _features(source, files, ["all"], text, ["__best", "__mean"], carried, most)
    z = F.lit(float(w[0])) + F.lit(float(w[1])) * F.col("__best") + F.lit(float(w[2])) * F.col("__mean")
    score = 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-700.0)), F.lit(700.0))))
    return made.select(*quoted(carried), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))


def ordinary(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    kept = scored(wrapped(docs, text), labels, carry_text=True).filter("predicted = 0")
    return unwrapped(kept, docs, text)


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

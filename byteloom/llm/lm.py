"""Scoring documents with a self-attention model, against a word-count base.

The probability of a text is a product over its words and its end.  Each is a
mixture of two distributions: the training words by their corpus counts, and
all words as sequences of subword ids by the attention model.  The share of
the two is fitted on sample texts that the attention model was not fitted on.
"""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.llm import common
from byteloom.llm.attention import CONTEXTS, EMBEDDED, Attention, Vocabulary, vocabulary
from byteloom.llm.tokenfiles import encoder, gathered, pieces, split_words

#: Training texts that the attention model starts from at least, picked by a hash of the
#: id, and one of how many texts of a large corpus; and more of them for the share of the mixture.
SAMPLE_TEXTS, SAMPLE_OF, SHARE_TEXTS = 1_000, 400, 200
#: Parts of the training rows that the attention model is fitted on in turn, and its rate on the first.
ROUNDS, ROUND_RATE = 4, 2e-3
#: Numbers of a parameter that are averaged in one group.
CHUNK = 2048
#: Words in memory of a task, those with the largest counts; the others are joined.
FREQUENT = 200_000
#: Distinct words that a task counts before it passes them on.
COUNTED = 400_000
#: Words whose values a worker remembers.
KNOWN = 400_000
#: The end of a text among its words, which are never empty.
END = b""


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Of every text's words and its end, one after another: their numbers; what each number stands for; how many each text has."""
    number: dict[bytes, int] = {}
    place = [number.setdefault(w, len(number)) for words in texts for w in (*words, END)]
    return np.array(place, np.int64), list(number), np.array([len(t) + 1 for t in texts], np.int64)


def numbered_texts(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """`numbered` of the words of whole texts."""
    place, words, counts = split_words(pc.ascii_lower(texts))
    of = np.repeat(np.arange(len(counts)), counts)
    # White space at an end of a text is no word.
    real = (pc.binary_length(words).to_numpy() > 0)[place]
    lengths = np.bincount(of[real], minlength=len(counts)) + 1
    out = np.full(lengths.sum(), len(words))
    inside = np.ones(len(out), bool)
    inside[np.cumsum(lengths) - 1] = False
    out[inside] = place[real]
    return out, [*words.cast(pa.large_string()).cast(pa.large_binary()).to_pylist(), END], lengths


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, mod 5; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c): how often each word, and the end, is in all rows of `body`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                held.update(words_of(text.as_py()))
                held[END] += 1
                if len(held) > COUNTED:
                    yield flush()
        yield flush()

    return texts.select("body").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


def follower_counts(counts: DataFrame, tokenizer_path: str) -> DataFrame:
    """(before, id, n): how often an id follows another within the counted words; before is -1 at word starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 20_000):
                some = batch.slice(start, 20_000)
                codes = encoder(tokenizer_path).encode_words([some.column(0).to_pylist()])[0]
                lengths = np.array([len(c) // 4 for c in codes])
                ids = np.frombuffer(b"".join(codes), "<u4").astype(np.int64)
                before = np.where(first_ids(lengths), -1, np.concatenate([[-1], ids[:-1]])[: len(ids)])
                pair, place = np.unique((before + 1) << 32 | ids, return_inverse=True)
                n = np.bincount(place, np.repeat(some.column(1).to_numpy(), lengths), len(pair))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((pair >> 32) - 1), pa.array(pair & 0xFFFFFFFF), pa.array(n.astype(np.float64))],
                    ["before", "id", "n"],
                )

    found = counts.where(F.length("word") > 0).mapInArrow(run, "before bigint, id bigint, n double")
    return found.groupBy("before", "id").agg(F.sum("n").alias("n"))


def id_counts(followers: DataFrame, ends: int, size: int) -> np.ndarray:
    """How often each subword id, and the end as the last, is in the counted words."""
    # At most a row for each id of the tokenizer.
    rows = followers.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1)
    out[rows["id"].to_numpy()] = rows["n"].to_numpy()
    out[size] = ends
    return out


def pair_counts(followers: DataFrame, words: Vocabulary, ends: int) -> np.ndarray:
    """How often each embedding row follows each context; the end follows a word start."""
    shared = followers.sparkSession.sparkContext.broadcast(words)
    shape = (CONTEXTS, EMBEDDED + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total = np.zeros(shape[0] * shape[1])
        for batch in batches:
            before, ids, n = (c.to_numpy() for c in batch.columns)
            context = np.where(before < 0, CONTEXTS - 1, np.minimum(known.row[np.maximum(before, 0)], CONTEXTS - 2))
            total += np.bincount(context * shape[1] + known.row[ids], n, len(total))
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["pair", "n"])

    # At most a row for each context and embedding row, whatever the corpus.
    rows = followers.mapInArrow(run, "pair bigint, n double").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(shape[0] * shape[1])
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    out[(CONTEXTS - 1) * shape[1] + words.row[-1]] += ends
    return out.astype(np.float32).reshape(shape)


def first_ids(lengths: np.ndarray) -> np.ndarray:
    """Marks the first id of every word; words may have none."""
    out = np.zeros(int(lengths.sum()), bool)
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    out[starts] = True
    return out


class Words:
    """What a worker knows of the words it met: ids, count, and log10 share of the ids in their groups."""

    def __init__(self, model: "Model"):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.codes: list[bytes] = []
        self.lengths = np.zeros(0, np.int64)
        self.counts, self.shares = np.zeros(0), np.zeros(0)

    def places(self, words: list[bytes]) -> np.ndarray:
        """The number of every word."""
        if len(self.index) > KNOWN:
            self.clear()
        fresh = list(set(words).difference(self.index))
        if fresh:
            model = self.model
            codes = encoder(model.tokenizer_path).encode_words([[w for w in fresh if w]])[0]
            codes = iter(codes)
            end = np.array([model.end_id], "<u4").tobytes()
            codes = [next(codes) if w else end for w in fresh]
            lengths = np.array([len(c) for c in codes]) // 4
            ids = np.frombuffer(b"".join(codes), "<u4").astype(np.int64)
            by_id = np.concatenate([[0.0], np.cumsum(model.attention.words.log_share(ids, first_ids(lengths)))])
            ends = np.cumsum(lengths)
            self.index.update(zip(fresh, range(len(self.codes), len(self.codes) + len(fresh))))
            self.codes += codes
            self.lengths = np.concatenate([self.lengths, lengths])
            self.shares = np.concatenate([self.shares, by_id[ends] - by_id[ends - lengths]])
            self.counts = np.concatenate([self.counts, [model.frequent.get(w, 0) for w in fresh]])
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


@dataclass
class Model:
    """Attention model, counts of the frequent words and of all, and the share of the counts in the mixture."""

    attention: Attention
    frequent: dict[bytes, int]
    total: int
    end_id: int
    tokenizer_path: str
    share: float = 0.5

    def __post_init__(self):
        self.words: Words | None = None

    def parts(self, place: np.ndarray, words: list[bytes], n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts (0 if not in memory), log10 by counts and log10 by attention of every word and end of `numbered` texts."""
        self.words = self.words or Words(self)
        number = self.words.places(words)
        lengths = self.words.lengths[number]
        codes = self.words.codes
        ids = np.frombuffer(b"".join([codes[i] for i in number.tolist()]), "<u4").astype(np.int64)
        ids, ends = gathered(ids, lengths, place)
        last = np.cumsum(n_words) - 1
        by_id = np.concatenate([[0.0], np.cumsum(self.attention.score(np.split(ids, ends[last][:-1])))])
        count = self.words.counts[number]
        with np.errstate(divide="ignore"):
            by_count = np.log10(count / max(1, self.total))
        return count[place], by_count[place], by_id[ends] - by_id[ends - lengths[place]] + self.words.shares[number][place]

    def mixed(self, by_count: np.ndarray, by_attention: np.ndarray) -> np.ndarray:
        ten = np.log(10)
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(self.share) + ten * by_count, np.log(1 - self.share) + ten * by_attention) / ten

    def fit_share(self, texts: list[list[bytes]], counts: dict[bytes, int], rounds: int = 30) -> None:
        """Expectation maximisation of the share, each text scored by the `counts` of all others."""
        if not texts or not self.frequent:
            self.share = 0.5 if self.frequent else 0.0
            return
        by_attention = self.parts(*numbered(texts))[2]
        count = np.array([counts.get(w, 0) for words in texts for w in (*words, END)])
        own = [Counter((*words, END)) for words in texts]
        here = np.array([n[w] for words, n in zip(texts, own) for w in (*words, END)])
        with np.errstate(divide="ignore"):
            by_count = np.log10(np.maximum(count - here, 0) / max(1, self.total))
        for _ in range(rounds):
            whole = self.mixed(by_count, by_attention)
            self.share = float(np.clip(np.mean(self.share * 10.0 ** (by_count - whole)), 0.01, 0.99))


def ids_of(texts: list[list[bytes]], tokenizer_path: str, end_id: int) -> list[np.ndarray]:
    """Subword ids of texts as words, the end last."""
    return [
        np.concatenate([np.frombuffer(b"".join(c), "<u4").astype(np.int64), [end_id]])
        for c in encoder(tokenizer_path).encode_words(texts)
    ]


def ids_of_texts(texts: pa.Array, tokenizer_path: str, end_id: int) -> list[np.ndarray]:
    """`ids_of` of the words of whole texts."""
    end = np.array([end_id], "<u4").tobytes()
    return [np.frombuffer(c + end, "<u4").astype(np.int64) for c in encoder(tokenizer_path).encode(pc.ascii_lower(texts))]


def fit_rows(attention: Attention, train: DataFrame, tokenizer_path: str, end_id: int) -> int:
    """Fit the attention model on all training rows, each in one step of one round; the number of windows.

    A round starts every task from the same parameters; the task makes its
    steps over its rows of the round, and the parameters of all tasks are
    averaged by their numbers of windows.  Only averages come to the driver.
    """
    if "A" not in attention.p:
        attention.add_layer()
    part = F.pmod(F.xxhash64("id", "body"), F.lit(ROUNDS))
    windows = 0
    for number in range(ROUNDS):
        shared = train.sparkSession.sparkContext.broadcast(attention)
        rate = ROUND_RATE * (1 - number / ROUNDS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = copy.deepcopy(shared.value)
            texts = (
                ids_of_texts(some.column(0), tokenizer_path, end_id) for batch in batches for some in pieces(batch, 0, 1 << 20)
            )
            n = model.fit_once(texts, rate, seed=number)
            if not n:
                return
            rows = [
                (name, at // CHUNK, n, TaskContext.get().partitionId(), value.ravel()[at : at + CHUNK].astype(np.float64) * n)
                for name, value in model.p.items()
                for at in range(0, value.size, CHUNK)
            ]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["name", "chunk", "n", "task", "value"])

        def total(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("task")
            summed = sum(v.values.to_numpy() for v in rows["value"])
            n = sum(rows["n"].to_pylist())
            return pa.table(
                [rows["name"][:1], rows["chunk"][:1], pa.array([n], pa.int64()), pa.array([summed / n], pa.list_(pa.float64()))],
                ["name", "chunk", "n", "value"],
            )

        # A row for each chunk of the parameters, whatever the corpus.
        means = (
            train.where(part == number).select("body").mapInArrow(run, "name string, chunk bigint, n bigint, task bigint, value array<double>")
            .groupBy("name", "chunk").applyInArrow(total, "name string, chunk bigint, n bigint, value array<double>")
            .toArrow().sort_by([("name", "ascending"), ("chunk", "ascending")]).to_pylist()
        )
        shared.destroy()
        values: dict[str, list[float]] = {}
        for row in means:
            values.setdefault(row["name"], []).extend(row["value"])
        attention.p.update({k: np.array(v, np.float32).reshape(attention.p[k].shape) for k, v in values.items()})
        windows += means[0]["n"] if means else 0
    attention.tables = None
    return windows


def fit(train: DataFrame, counts: DataFrame, total: int, tokenizer_path: str) -> Model:
    """A model of the training rows (`id`, `body`) of `total` words; id counts are over all of them.

    The attention model starts from steps on SAMPLE_TEXTS whole texts, or one of
    SAMPLE_OF if that is more, and is then fitted on all rows; the share is
    fitted on SHARE_TEXTS texts that the start leaves out.
    """
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer_path).get_vocab_size()
    # The end comes first, so that its count is there whatever the limit.
    top = counts.orderBy((F.length("word") == 0).desc(), F.col("c").desc(), "word").limit(FREQUENT).toArrow()
    frequent = dict(zip(map(bytes, top["word"].to_pylist()), top["c"].to_pylist()))
    sample = max(SAMPLE_TEXTS, frequent.get(END, 0) // SAMPLE_OF)
    picked = train.select("id").where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample + SHARE_TEXTS)
    # One of SAMPLE_OF texts of a large corpus.
    rows = train.join(F.broadcast(picked), "id").dropDuplicates(["id"]).select("id", "body").collect()
    texts = [words_of(r.body) for r in sorted(rows, key=lambda r: r.id)]
    rng = np.random.default_rng(3)
    rng.shuffle(texts)
    fitted = texts[: max(1, len(texts) * sample // (sample + SHARE_TEXTS))]
    ids = ids_of(fitted, tokenizer_path, size)
    followers = common.checkpointed(follower_counts(counts, tokenizer_path))
    ends = frequent.get(END, 0)
    words = vocabulary(id_counts(followers, ends, size), ids)
    words.set_pairs(pair_counts(followers, words, ends))
    attention = Attention(words)
    attention.fit(ids)
    fit_rows(attention, train, tokenizer_path, size)
    model = Model(attention, frequent, total, size, tokenizer_path)
    held = texts[len(fitted) :]
    # The words of at most SHARE_TEXTS texts.
    met = train.sparkSession.createDataFrame([(w,) for w in {w for words in held for w in (*words, END)}], "word binary")
    known = counts.join(F.broadcast(met), "word").toArrow()
    model.fit_share(held, dict(zip(map(bytes, known["word"].to_pylist()), known["c"].to_pylist())))
    model.words = None
    return model


def score(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score, per row.

    Learns from the rows whose crc32 of the id as text is not 1 modulo 5; the
    others are held out.  NULL is the empty text, which is its end alone; a
    NULL id counts as the empty text.  Repeated rows are counted and scored as
    often as they come.  An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), (remainder(id_col) == 1).alias("held_out"), common.text_of(text_col).alias("body")
    )
    train = rows.where(~F.col("held_out"))
    counts = common.checkpointed(word_counts(train))
    totals = counts.agg(F.sum("c"), F.count("*")).first()
    n, v = int(totals[0] or 0), int(totals[1] or 0)
    log_all = float(np.log10(n + 0.5 * (v + 1)))
    model = fit(train, counts, n, tokenizer_path)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                some = batch.slice(start, 128)
                place, words, lengths = numbered_texts(some.column(2))
                count, by_count, by_attention = model.parts(place, words, lengths)
                starts = np.cumsum(lengths) - lengths
                known = count > 0
                base = np.where(known, np.log10(count + 0.5) - log_all, 0)
                whole = np.where(known, model.mixed(by_count, by_attention), 0)
                # Words that are not in memory, and their values by attention at each place; counts are joined below.
                rare: list[dict[bytes, list[float]]] = [{} for _ in lengths]
                places = np.nonzero(~known)[0]
                of = np.searchsorted(starts, places, "right") - 1
                for text, at, value in zip(of.tolist(), places.tolist(), by_attention[places].tolist()):
                    rare[text].setdefault(words[place[at]], []).append(value)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + len(lengths))), some.column(0), some.column(1), pa.array(lengths),
                        pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                        pa.array(np.add.reduceat(base, starts)),
                        pa.array(np.add.reduceat(whole, starts)),
                        pa.ListArray.from_arrays(offsets, pa.array([w for r in rare for w in r], pa.binary())),
                        pa.ListArray.from_arrays(offsets, pa.array([v for r in rare for v in r.values()], pa.list_(pa.float64()))),
                    ],
                    ["row", "id", "held_out", "n_tokens", "known", "base", "score", "word", "places"],
                )
                number += len(lengths)

    kind = docs.schema[id_col].dataType.simpleString()
    scored = common.checkpointed(
        rows.mapInArrow(
            run,
            f"row bigint, id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, score double, "
            "word array<binary>, places array<array<double>>",
        )
    )
    c = F.coalesce("c", F.lit(0))
    # Model.mixed, for a word that is not in memory.
    by_count = F.when((c > 0) & F.lit(model.share > 0), F.log10(c / max(1, n)) + float(np.log10(max(model.share, 1e-300))))
    log_rest = float(np.log10(1 - model.share))

    def mixed(by_attention: Column) -> Column:
        x = by_attention + log_rest
        most = F.greatest(x, by_count)
        return F.when(by_count.isNull(), x).otherwise(most + F.log10(F.pow(F.lit(10.0), x - most) + F.pow(F.lit(10.0), by_count - most)))

    rare = (
        scored.select("row", F.explode(F.arrays_zip("word", "places")).alias("rare"))
        .select("row", F.col("rare.word").alias("word"), F.col("rare.places").alias("places"), F.size("rare.places").alias("times"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * (F.log10(c + 0.5) - log_all)).alias("rare_base"),
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.aggregate("places", F.lit(0.0), lambda all_, x: all_ + mixed(x))).alias("rare_score"),
        )
    )
    return scored.join(rare, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    import public_tokenizers

    return score(common.table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))

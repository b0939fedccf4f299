"""Language identification by word-first backoff.

Training counts, for every language, the lower-cased letter runs ("words") of all
labelled texts, and the 1- to 4-grams of characters of those words (with a mark at
both ends). A text is scored word by word: a word of the model adds its log
frequency in each language; an unseen word adds the mean log frequency of its known
4-grams, or, with none known, of its 3-grams, 2-grams, characters. The language with
the highest sum wins; the score is its posterior with the evidence capped at that of
``EVIDENCE_WORDS`` average words, so that long texts don't all end at exactly 1.

All labelled texts are counted, and the counts of all words and n-grams are written
tables. The head of each, which is broadcast, has every language's most frequent entries,
``MODEL_ENTRIES`` / number of languages of each at most, so at most ``MODEL_ENTRIES`` at
any corpus size and shares of the languages, with their exact counts in every language.
Where the head of words doesn't hold everything, the words outside are joined with the table of
words. Words that were never seen go by the head of n-grams; where that doesn't hold
all n-grams, those of their n-grams that it lacks, and that could count, are joined with the
table of n-grams. For the join a
task numbers the words that its rows have outside the head, in blocks of at most
``BLOCK_WORDS`` words (and one text's) and ``BLOCK_ROWS`` rows: a word is joined once a
block, and the block's rows, as numbers, meet its vectors in one task. Both ways a word
has the same vector of 32-bit logs, summed in double precision.

Defined results: null text, or one without a letter, gives ``und`` with score 0, as
does any text if nothing was learned; rows without a label teach nothing; ties go to
the language that sorts first; repeated rows count as often as they occur.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, released, text_batches, whole_row, written

UND = "und"
MODEL_ENTRIES = 1 << 18
LONGEST_GRAM = 4
EVIDENCE_WORDS = 20
#: Added to every count, so that no language gives a known entry probability 0.
SMOOTHING = 0.1
#: A counting task hands on its counts when it holds so many different entries.
FLUSH_ENTRIES = 250_000

#: Words and rows of a block.
BLOCK_WORDS = 1 << 17
BLOCK_ROWS = 20_000

LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    marked = f"\x02{word}\x03" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _emit(counts: dict[str, Counter]) -> Iterator[pd.DataFrame]:
    for lang, own in counts.items():
        if own:   # texts without letters leave nothing to hand on
            yield pd.DataFrame({"lang": [lang] * len(own), "entry": list(own), "n": list(own.values())})
    counts.clear()


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            counts.setdefault(lang, Counter()).update(letter_words(text))
        if sum(map(len, counts.values())) > FLUSH_ENTRIES:
            yield from _emit(counts)
    yield from _emit(counts)


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, word, n in zip(batch["lang"], batch["entry"], batch["n"]):
            own = counts.setdefault(lang, Counter())
            for size in range(1, LONGEST_GRAM + 1):
                for gram in grams(word, size):
                    own[gram] += n
        if sum(map(len, counts.values())) > FLUSH_ENTRIES:
            yield from _emit(counts)
    yield from _emit(counts)


def _least(counts: DataFrame, langs: list[str], most: int) -> list[int]:
    """For every language, the smallest count that at most ``most`` of its entries reach.

    Different counts are few: k of them need k^2 / 2 occurrences.
    """
    sizes = counts.groupBy("lang", "n").agg(F.count("*").alias("entries")).toArrow().to_pandas().sort_values("n", ascending=False)
    found = []
    for lang in langs:
        own = sizes[sizes["lang"] == lang]
        fits = own["n"][own["entries"].cumsum() <= most]
        found.append(int(fits.min()) if len(fits) else int(own["n"].max()) + 1)
    return found


def _counted(counts: DataFrame, bound: int, what: str) -> tuple[tuple[list[str], Any], DataFrame, bool]:
    """((entries, logs) of the head, table of entry and logs of all, whether the head has all).

    logs: log frequencies, in the order of the sorted languages.
    """
    import numpy as np

    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return ([], np.zeros((0, 0), "float32")), counts.select("entry", F.array().cast("array<double>").alias("logs")), True
    own = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)) for x in langs]
    wide = written(counts.groupBy("entry").agg(F.array(*own).alias("n")), what)
    number = wide.count()
    logs = F.array(*[F.log((F.col("n")[i] + SMOOTHING) / F.lit(totals[x] + SMOOTHING * (number + 1))) for i, x in enumerate(langs)])
    least = _least(counts, langs, bound // len(langs))
    enough = F.lit(False)
    for i, n in enumerate(least):
        enough = enough | (F.col("n")[i] >= n)
    every = wide.select("entry", logs.alias("logs"))
    head = wide.filter(enough).select("entry", logs.alias("logs")).toArrow()
    values = np.array(head["logs"].combine_chunks().flatten()).reshape(-1, len(langs))
    return (head["entry"].to_pylist(), values), every, len(values) == number


def train(docs: DataFrame, text: str = "text", lang: str = "lang", entries: int = MODEL_ENTRIES) -> dict[str, Any]:
    """Learn from the rows of ``docs`` that have a text and a language.

    ``tables``: those of all words and of all n-grams (None if their head has them); None if the heads have all of both.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    schema = "lang string, entry string, n long"
    counted = written(rows.mapInPandas(_count_words, schema).groupBy("lang", "entry").agg(F.sum("n").alias("n")), "words")
    words, all_words, every_word = _counted(counted, entries, "all_words")
    gram_counts = counted.mapInPandas(_count_grams, schema).groupBy("lang", "entry").agg(F.sum("n").alias("n"))
    own_grams, all_grams, every_gram = _counted(written(gram_counts, "grams"), entries, "all_grams")
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    return {"langs": langs, "words": words, "grams": own_grams,
            "tables": None if every_word and every_gram else (all_words, None if every_gram else all_grams)}


def _backed_off(words: list[str], known: dict[str, int], gram_logs: Any) -> Any:
    """A row per word: the mean over its longest known n-grams, 0 where no character is known."""
    import numpy as np

    flat, sizes = [], []
    for word in words:
        own: list[int] = []
        for n in range(LONGEST_GRAM, 0, -1):
            own = [i for g in grams(word, n) if (i := known.get(g)) is not None]
            if own:
                break
        flat += own
        sizes.append(len(own))
    size = np.array(sizes, "int64")
    out = np.zeros((len(words), gram_logs.shape[1]))
    some = np.flatnonzero(size)
    if len(some):
        starts = (np.cumsum(size) - size)[some]
        out[some] = np.add.reduceat(gram_logs[flat].astype("float64"), starts, axis=0) / size[some, None]
    return out


class _Scorer:
    """Holds the model inside a worker; vectors of unseen words are kept as they come up."""

    KEPT = 150_000

    def __init__(self, model: dict[str, Any]):
        import numpy as np

        self.np, self.langs = np, model["langs"]
        self.words, self.word_logs = model["words"]
        self.word_logs = self.word_logs.astype("float32")
        names, self.gram_logs = model["grams"]
        self.grams = {g: i for i, g in enumerate(names)}
        if self.langs:
            self._start()

    def _start(self) -> None:
        np = self.np
        self.rows = {w: i for i, w in enumerate(self.words)}
        self.logs = np.vstack([self.word_logs.reshape(-1, len(self.langs)),
                               np.zeros((self.KEPT, len(self.langs)), "float32")])
        self.used, self.fresh = len(self.words), []

    def _row(self, word: str) -> int:
        row = self.rows.get(word)
        if row is None:
            row = self.rows[word] = self.used
            self.used += 1
            self.fresh.append(word)
        return row

    def _fill(self) -> None:
        """The vectors of words seen for the first time."""
        self.logs[self.used - len(self.fresh):self.used] = _backed_off(self.fresh, self.grams, self.gram_logs)
        self.fresh = []

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        found = letter_words(text) if text is not None else []
        if not any(c.isalpha() for w in found for c in w):
            return UND, 0.0, False
        if not self.langs:
            return UND, 0.0, True
        np, total = self.np, 0.0
        for at in range(0, len(found), 100_000):   # very long texts in parts, so that the kept vectors stay bounded
            part = found[at:at + 100_000]
            if self.used + len(part) > len(self.logs):
                self._start()
            rows = np.fromiter(map(self._row, part), "int64", len(part))
            if self.fresh:
                self._fill()
            total = total + self.logs[rows].sum(0, dtype="float64")
        weighed = total * min(1.0, EVIDENCE_WORDS / len(found))
        shares = np.exp(weighed - weighed.max())
        best = int(shares.argmax())
        return self.langs[best], float(shares[best] / shares.sum()), True


class _HeadScorer:
    """Sums over the words of the head, and the words outside it, inside a worker."""

    def __init__(self, model: dict[str, Any]):
        import numpy as np

        self.np, self.langs = np, model["langs"]
        words, logs = model["words"]
        self.rows = {w: i for i, w in enumerate(words)}
        self.logs = logs.reshape(-1, len(self.langs)).astype("float32")

    def __call__(self, text: str | None) -> tuple[bool, int, list[float], Counter]:
        """Whether there is a letter, number of words, sums, and how often each word outside the head occurs."""
        found = letter_words(text) if text is not None else []
        total, rest = self.np.zeros(len(self.langs)), Counter()
        for at in range(0, len(found), 100_000):
            part = found[at:at + 100_000]
            rows = self.np.fromiter(map(self.rows.get, part, repeat(-1)), "int64", len(part))
            outside = self.np.flatnonzero(rows < 0)
            total += self.logs[rows[rows >= 0]].sum(0, dtype="float64")
            rest.update(part[i] for i in outside)
        return any(c.isalpha() for w in found for c in w), len(found), total, rest


class _Blocks:
    """Numbers the words outside the head that a task meets; a full block ends, and the next begins at 0."""

    def __init__(self, task: int):
        self.task, self.block, self.rows, self.numbers = task, 0, 0, {}

    def __call__(self, rest: Counter) -> tuple[int, int, list[str], list[int], list[int]]:
        """Block, number of its words so far, words that are new to it, and the numbers and occurrences of the text's words."""
        if self.rows >= BLOCK_ROWS or len(self.numbers) >= BLOCK_WORDS:
            self.block, self.rows, self.numbers = self.block + 1, 0, {}
        first, self.rows = len(self.numbers), self.rows + 1
        own = [self.numbers.setdefault(w, len(self.numbers)) for w in rest]
        return self.task << 32 | self.block, first, [w for w, n in zip(rest, own) if n >= first], own, list(rest.values())


def _parts(spark: SparkSession, model: dict[str, Any]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Of every word: the longest size with n-grams in the head (0: none), their number and sums, and the n-grams
    of that size and longer ones that the head lacks."""
    head, langs = spark.sparkContext.broadcast(model["grams"]), len(model["langs"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, logs = head.value
        known = {g: i for i, g in enumerate(names)}
        for batch in batches:
            rows = []
            for word in batch["word"]:
                outside: list[tuple[int, str]] = []
                own: list[int] = []
                size = LONGEST_GRAM + 1
                while not own and size > 1:
                    size -= 1
                    for g in grams(word, size):
                        if (i := known.get(g)) is None:
                            outside.append((size, g))
                        else:
                            own.append(i)
                sums = logs[own].astype("float64").sum(0) if own else [0.0] * langs
                rows.append((word, size if own else 0, len(own), sums, [n for n, _ in outside], [g for _, g in outside]))
            yield pd.DataFrame(rows, columns=["word", "size", "number", "sums", "sizes", "outside"])
    return run


def _vectors(words: DataFrame, model: dict[str, Any]) -> DataFrame:
    """word and its logs: from the table of words, or means over its longest known n-grams; none or 0 if no character is known."""
    (all_words, all_grams), langs = model["tables"], len(model["langs"])
    found = written(words.join(all_words.withColumnRenamed("entry", "word"), "word", "left"), "outside")
    unseen = found.filter("logs IS NULL").select("word")
    parts = unseen.mapInPandas(_parts(words.sparkSession, model), "word string, size int, number int, sums array<double>, sizes array<int>, outside array<string>")
    mean = lambda sums, number: F.transform(sums, lambda x: x / number)
    nothing = F.size("outside") == 0
    if all_grams is None:
        nothing = F.lit(True)
    else:
        parts = written(parts, "parts")
    done = parts.filter(nothing & (F.col("number") > 0)).select("word", mean(F.col("sums"), F.col("number")).alias("logs"))
    if all_grams is not None:
        done = done.union(_completed(parts.filter(~nothing), all_grams, langs, mean))
    return found.filter("logs IS NOT NULL").union(done).select("word", F.col("logs").cast("array<float>").alias("logs"))


def _completed(parts: DataFrame, all_grams: DataFrame, langs: int, mean) -> DataFrame:
    """word and logs of words with n-grams outside the head: those that were seen count with the head's of their size."""
    one = parts.select("word", F.explode(F.arrays_zip("sizes", "outside")).alias("x")).select("word", F.col("x.sizes").alias("size"), F.col("x.outside").alias("gram"))
    sums = F.array(*[F.sum(F.col("logs")[i]) for i in range(langs)])
    seen = (one.join(all_grams.withColumnRenamed("entry", "gram"), "gram").groupBy("word", "size").agg(sums.alias("sums"), F.count("*").alias("number"))
            .groupBy(F.col("word").alias("w")).agg(F.max_by(F.struct("size", "sums", "number"), "size").alias("more")))
    both = parts.select("word", "size", "number", "sums").join(seen, F.col("word") == F.col("w"), "left")
    longer = F.col("more.size") > F.col("size")
    added = F.col("more.size") == F.col("size")
    logs = (F.when(longer, mean(F.col("more.sums"), F.col("more.number")))
            .when(added, mean(F.zip_with("sums", "more.sums", lambda a, b: a + b), F.col("number") + F.col("more.number")))
            .when(F.col("number") > 0, mean(F.col("sums"), F.col("number"))))
    return both.select("word", logs.alias("logs")).filter("logs IS NOT NULL")


def _sums(langs: int):
    """For a block: the vectors of its words, summed by row."""
    import numpy as np

    def run(rows: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"r": [], "rest": []})
        own = rows["numbers"].tolist()
        sizes = np.array([len(x) for x in own])
        logs = np.zeros((max(int(x.max()) for x in own) + 1, langs), "float32")   # a word of which nothing is known adds 0
        if len(vectors):
            logs[vectors["number"].to_numpy()] = np.vstack(vectors["logs"].tolist())
        sums = np.empty((len(own), langs))
        for i, (numbers, times) in enumerate(zip(own, rows["times"])):
            sums[i] = (logs[numbers].astype("float64") * np.asarray(times)[:, None]).sum(0)
        return pd.DataFrame({"r": rows["row"].to_numpy(), "rest": list(sums)}).loc[sizes > 0]
    return run


def _predict_joined(rows: DataFrame, model: dict[str, Any]) -> DataFrame:
    """kept and found as ``predict`` needs them, where the heads don't hold all words and n-grams."""
    langs = model["langs"]
    shared = rows.sparkSession.sparkContext.broadcast({"langs": langs, "words": model["words"]})

    @F.pandas_udf("struct<has_letter:boolean,size:long,head:array<double>,block:long,first:int,new:array<string>,numbers:array<int>,times:array<int>>")
    def read(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer, blocks = _HeadScorer(shared.value), _Blocks(TaskContext.get().partitionId())
        for part in parts:
            found = [scorer(t) for t in part]
            yield pd.DataFrame([(letter, size, total, *blocks(rest)) for letter, size, total, rest in found],
                               columns=["has_letter", "size", "head", "block", "first", "new", "numbers", "times"])

    scored = written(rows.select("kept", read("text").alias("s")).select("kept", "s.*", F.monotonically_increasing_id().alias("row")), "scored")
    wanted = (scored.select("block", "first", F.posexplode("new").alias("at", "word"))
              .select("block", (F.col("first") + F.col("at")).alias("number"), "word"))
    vectors = wanted.join(_vectors(wanted.select("word").distinct(), model), "word").select(F.col("block").alias("of"), "number", "logs")
    with_rest = scored.filter(F.size("numbers") > 0).select("block", "row", "numbers", "times")
    rest = with_rest.groupBy("block").cogroup(vectors.groupBy("of")).applyInPandas(_sums(len(langs)), "r long, rest array<double>")
    nothing = F.array(*[F.lit(0.0)] * len(langs))
    whole = (scored.select("kept", "has_letter", "size", "head", "row").join(rest, F.col("row") == F.col("r"), "left")
             .withColumn("total", F.zip_with("head", F.coalesce("rest", nothing), lambda a, b: a + b)))
    weight = F.least(F.lit(1.0), F.lit(float(EVIDENCE_WORDS)) / F.col("size"))
    best = F.array_max("total")
    shares = F.aggregate("total", F.lit(0.0), lambda sum_, x: sum_ + F.exp((x - best) * weight))
    lang = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("total", best).cast("int"))
    known = F.col("has_letter")
    return whole.select("kept", F.struct(F.when(known, lang).otherwise(UND).alias("lang_pred"),
                                         F.when(known, 1 / shares).otherwise(0.0).alias("score"), "has_letter").alias("found"))


def predict(docs: DataFrame, model: dict[str, Any], text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """Columns ``keep`` (default: the whole row as ``row``), lang_pred, score, has_letter."""
    text_batches(docs.sparkSession)
    keep = keep or [whole_row(docs).alias("row")]
    rows = docs.select(carried(keep).alias("kept"), F.col(text).alias("text"))
    if model.get("tables"):
        return _predict_joined(rows, model).select(*released(keep), "found.*")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double,has_letter:boolean>")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(shared.value)
        for part in parts:
            yield pd.DataFrame([scorer(t) for t in part], columns=["lang_pred", "score", "has_letter"])

    return rows.withColumn("found", score("text")).select(*released(keep), "found.*")

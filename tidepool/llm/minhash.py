"""Near-dedup by SuperMinHash signatures, banding, verification and components.

Shingles: A-Z are lowered, words are split at ASCII blanks, a text's set holds its
distinct runs of five words (with fewer words: the whole sequence as one), each a
64-bit hash. Two texts are linked when 100 * intersection >= percent * union.

1. One pass over the texts gives every document its set's size and 128-bit digest, a
   SuperMinHash signature, the hashes of its bands, and one byte per position. In a
   SuperMinHash, each element draws a random permutation of the positions, and its
   rank in it leads its value: level 0 values beat level 1 values, and so on. The
   levels are run for all elements of a batch at once; a document stops at the first
   level at which each of its positions has been reached.
2. Equal sets become one class; only classes take part from here on, so copies cost
   one row however many there are.
3. In every bucket (classes that share a band) each class is paired with the smallest
   and the largest member: a number of pairs linear in the bucket's size. Pairs whose
   byte estimate is far below the threshold are left out (see ``ESTIMATE_SLACK``), the
   others are verified on the full sets, and components are formed.
4. Where a bucket still spans several components, the members outside its main component
   are estimated against all others, in pieces of bounded size and inside a task; members
   with a promising partner (not the pairs) go on, and their pieces are verified on
   the full sets by a product of membership matrices. Only links that join components
   come out. So no link of a bucket is lost, and no list of pairs of a group is made.

Banding is 30 bands of 4 positions: a pair at 0.85 misses every band with probability
4e-10, one at 0.8 with 1.4e-7.

Defined results: null, empty and blank-only texts have an empty set, size 0, and are
linked with nothing; repeated ids are separate rows (with equal sets they are one
class); columns beside id and text are not looked at; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import sieve, slot, text_batches, whole_row, written
from .components import components
from .hashing import WordHashes, coefficients, mix, multiple

SHINGLE_WORDS = 5
BANDS = 30
BAND_ROWS = 4
POSITIONS = BANDS * BAND_ROWS
#: A pair is verified unless its estimate is more than this below the threshold. The
#: estimate's standard deviation is 0.037 at most near 0.8: five of them.
ESTIMATE_SLACK = 0.19
#: Members of a bucket that are estimated against each other in one piece.
TILE_ROWS = 512
_LOW = np.uint64(0xFFFFFFFF)
_COEFFICIENTS = coefficients(SHINGLE_WORDS)


def shingles(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.lower().split() if text else []   # bytes: only A-Z are lowered, only ASCII blanks split
    if not words:
        return np.empty(0, "uint64")
    ids = hashes.of(words)
    if len(ids) < SHINGLE_WORDS:
        return mix((ids * _COEFFICIENTS[:len(ids)]).sum(keepdims=True) + np.uint64(len(ids)))
    size = len(ids) - SHINGLE_WORDS + 1
    total = ids[:size] * _COEFFICIENTS[0]
    for i in range(1, SHINGLE_WORDS):
        total += ids[i:size + i] * _COEFFICIENTS[i]
    return np.unique(mix(total))


def superminhash(elements: np.ndarray, sizes: np.ndarray, positions: int = POSITIONS) -> np.ndarray:
    """Signatures of several sets, laid end to end in ``elements``: level << 32 | random part."""
    sets = len(sizes)
    signature = np.full(sets * positions, np.iinfo("uint64").max, "uint64")
    owner = np.repeat(np.arange(sets), sizes)
    places = None
    for level in range(positions):
        if not len(elements):
            break
        drawn = mix(elements + multiple(level + 1))
        choice = (level + (((drawn & _LOW) * np.uint64(positions - level)) >> np.uint64(32))).astype("int64")
        place = choice if places is None else places[np.arange(len(elements)), choice]
        np.minimum.at(signature, owner * positions + place, (np.uint64(level) << np.uint64(32)) | (drawn >> np.uint64(32)))
        reached = signature.reshape(sets, positions).max(1) < np.uint64(level + 1) << np.uint64(32)
        going = ~reached[owner]
        if places is None:
            places = np.tile(np.arange(positions, dtype="uint8" if positions <= 256 else "int32"), (int(going.sum()), 1))
        else:
            places = places[going]
        elements, owner, choice = elements[going], owner[going], choice[going]
        places[np.arange(len(elements)), choice] = places[:, level]   # the swap; position ``level`` isn't drawn again
    return signature.reshape(sets, positions)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each band, different between bands of equal content."""
    cut = signature.reshape(len(signature), BANDS, BAND_ROWS)
    value = np.array([multiple(i) for i in range(1, BANDS + 1)], "uint64") + np.zeros((len(signature), 1), "uint64")
    for i in range(BAND_ROWS):
        value = mix(value ^ mix(cut[:, :, i] + multiple(i + 1)))
    return value


def _sum_by(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.concatenate([np.zeros(1, "uint64"), np.cumsum(values, dtype="uint64")])
    stops = np.cumsum(sizes)
    return ends[stops] - ends[stops - sizes]


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        sets = [shingles(t, hashes) for t in batch["text"]]
        hashes.trim()
        sizes = np.array([len(s) for s in sets], "int64")
        together = np.concatenate(sets) if sets else np.empty(0, "uint64")
        signature = superminhash(together, sizes)
        bands = band_hashes(signature).view("int64")
        marks = (mix(signature) >> np.uint64(56)).astype("uint8")
        yield pd.DataFrame({
            "id": batch["id"], "tag": batch["tag"], "n": sizes,
            "cls": mix(_sum_by(mix(together), sizes) + sizes.astype("uint64")).view("int64"),
            "check": _sum_by(mix(together + multiple(1)), sizes).view("int64"),
            "bands": [b if n else None for b, n in zip(bands, sizes)],
            "mark": [m.tobytes() if n else None for m, n in zip(marks, sizes)]})


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: id, tag (hash of the text), n, cls and check (the set's digest), bands, mark."""
    text_batches(docs.sparkSession)
    kind = docs.select(F.col(doc_id).alias("id")).schema["id"].dataType.simpleString()
    return (docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("tag"), F.col(text).cast("binary").alias("text"))
            .mapInPandas(_sign, f"id {kind}, tag long, n long, cls long, check long, bands array<long>, mark binary"))


def _sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """cls and shingles of the wanted classes (columns id and tag of a member, cls), from the whole texts again."""
    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, hashes) for t in batch["text"]]
            hashes.trim()
            cls = [mix(mix(s).sum(keepdims=True) + np.uint64(len(s))).view("int64")[0] for s in sets]
            yield pd.DataFrame({"cls": cls, "shingles": [s.view("int64") for s in sets]})

    ids = wanted.select("id", "tag").distinct()
    rows = (docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("tag"), F.col(text).cast("binary").alias("text"))
            .withColumn("slot", slot([F.col("id"), F.col("tag")])).join(F.broadcast(sieve(ids)), "slot", "left_semi"))
    named = ids.select(F.col("id").alias("member_id"), F.col("tag").alias("member_tag"))
    near = rows.join(named, F.col("id").eqNullSafe(F.col("member_id")) & (F.col("tag") == F.col("member_tag")), "left_semi")
    one = near.select("text").mapInPandas(expand, "cls long, shingles array<long>")
    return one.join(wanted.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))


@F.pandas_udf(DoubleType())
def _estimate(left: pd.Series, right: pd.Series) -> pd.Series:
    a = np.frombuffer(b"".join(left), "uint8").reshape(len(left), -1)
    b = np.frombuffer(b"".join(right), "uint8").reshape(len(right), -1)
    return pd.Series((a == b).mean(1) if len(left) else [], dtype="float64")


def _promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    marks = classes.select("cls", "mark")
    both = (pairs.join(marks.withColumnsRenamed({"cls": "a", "mark": "mark_a"}), "a")
            .join(marks.withColumnsRenamed({"cls": "b", "mark": "mark_b"}), "b"))
    return both.filter(_estimate("mark_a", "mark_b") >= percent / 100 - ESTIMATE_SLACK).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("set_b")), "b"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b")


#: What names a piece of a bucket: outsiders with outsiders, or with members of the main component.
PIECE = ["key", "main", "i", "j"]


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole pieces out of a partition that is sorted by ``PIECE``; a piece holds two tiles at most."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(rows):
            continue
        names = rows[PIECE].to_numpy()
        starts = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]).any(1)])
        for begin, end in zip(starts[:-1], starts[1:]):
            yield rows.iloc[begin:end]
        rest = rows.iloc[starts[-1]:]   # may go on in the next batch
    if rest is not None:
        yield rest


def _hopeful(percent: int):
    """Of every piece, the members with a partner in another component that the estimate allows.

    A pair is looked at in one bucket only, that of the first band which the two share.
    """
    least = percent / 100 - ESTIMATE_SLACK

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in _pieces(batches):
            side, root, key = piece["side"].to_numpy(), piece["root"].to_numpy(), piece["key"].iloc[0]
            marks = np.frombuffer(b"".join(piece["mark"]), "uint8").reshape(len(piece), -1)
            bands = np.array(piece["bands"].tolist())
            first = bands[:, :int(np.flatnonzero(bands[0] == key)[0])]
            right = np.flatnonzero(side != 0)
            hit = np.zeros(len(piece), bool)
            for i in np.flatnonzero(side != 1):
                other = right[root[right] != root[i]]
                other = other[~(first[other] == first[i]).any(1)]
                other = other[(marks[other] == marks[i]).mean(1) >= least]
                hit[other] = True
                hit[i] |= len(other) > 0
            if hit.any():
                yield piece.loc[hit, [*PIECE, "side", "cls", "root"]]

    return run


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of two lists of sets, as a product of membership matrices."""
    values, at, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[at]   # values of one member cannot be shared
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), "float32")
    for start in range(0, int(column.max(initial=-1)) + 1, 2048):
        begin, end = np.searchsorted(column, [start, start + 2048])
        member = np.zeros((len(left) + len(right), 2048), "float32")
        member[owner[begin:end], column[begin:end] - start] = 1
        out += member[:len(left)] @ member[len(left):].T
    return out.astype("int64")


def _blocks(sets: list[np.ndarray], most: int = 1_000_000) -> Iterator[np.ndarray]:
    """Positions in runs of at most ``most`` elements (or one set)."""
    begin, held = 0, 0
    for i, s in enumerate(sets):
        if i > begin and held + len(s) > most:
            yield np.arange(begin, i)
            begin, held = i, 0
        held += len(s)
    yield np.arange(begin, len(sets))


def _spanning(percent: int):
    """Links of a piece, on full sets, that join components not joined by an earlier link of it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in _pieces(batches):
            side, cls, sets = piece["side"].to_numpy(), piece["cls"].to_numpy(), piece["shingles"].tolist()
            roots = {r: r for r in piece["root"].tolist()}
            own = piece["root"].tolist()

            def find(r: int) -> int:
                while roots[r] != r:
                    roots[r] = r = roots[roots[r]]
                return r

            found, left, right = [], np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            for x in _blocks([sets[i] for i in left]):
                for y in _blocks([sets[j] for j in right]):
                    one, two = left[x], right[y]
                    a, b = [sets[i] for i in one], [sets[j] for j in two]
                    shared = shared_counts(a, b)
                    union = np.array([len(v) for v in a])[:, None] + np.array([len(v) for v in b]) - shared
                    for i, j in zip(*np.nonzero((100 * shared >= percent * union) & (one[:, None] != two))):
                        r, q = find(own[one[i]]), find(own[two[j]])
                        if r != q:
                            roots[r] = q
                            found.append((min(cls[one[i]], cls[two[j]]), max(cls[one[i]], cls[two[j]])))
            if found:
                yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _pieced(rooted: DataFrame) -> DataFrame:
    """Members (key, cls, root) of buckets that span several components, dealt into ``PIECE``s.

    Each bucket's most frequent component is its main one. Its members need not meet each
    other, so they meet the outsiders only; with few outsiders the pieces are few.
    """
    counted = rooted.groupBy("key", "root").agg(F.count("*").alias("size"))
    sizes = (counted.groupBy("key").agg(F.max(F.struct("size", "root")).alias("most"), F.sum("size").alias("all"), F.count("*").alias("roots"))
             .filter("roots > 1")
             .select(F.col("key").alias("own"), F.col("most.root").alias("main_root"),
                     F.ceil(F.col("most.size") / TILE_ROWS).alias("main_tiles"),
                     F.ceil((F.col("all") - F.col("most.size")) / TILE_ROWS).alias("out_tiles")))
    rows = rooted.join(sizes, F.col("key") == F.col("own")).withColumn("inside", F.col("root") == F.col("main_root"))
    zero = F.lit(0).cast("long")
    tile = F.pmod(F.xxhash64("cls"), F.when(F.col("inside"), F.col("main_tiles")).otherwise(F.col("out_tiles")))
    rows = rows.withColumn("tile", tile)
    with_out = F.transform(F.sequence(zero, F.col("out_tiles") - 1), lambda o: F.struct(
        F.col("inside").alias("main"),
        F.when(F.col("inside"), o).otherwise(F.least("tile", o)).alias("i"),
        F.when(F.col("inside"), F.col("tile")).otherwise(F.greatest("tile", o)).alias("j"),
        F.when(F.col("inside"), 1).when(F.col("tile") == o, 2).when(F.col("tile") < o, 0).otherwise(1).alias("side")))
    with_main = F.transform(F.sequence(zero, F.col("main_tiles") - 1), lambda m: F.struct(
        F.lit(True).alias("main"), F.col("tile").alias("i"), m.alias("j"), F.lit(0).alias("side")))
    dealt = F.when(F.col("inside"), with_out).otherwise(F.concat(with_out, with_main))
    return rows.select("key", "cls", "root", F.explode(dealt).alias("p")).select("key", "cls", "root", "p.*")


def links(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): document rows with their class, the classes, and verified links between classes.

    The links span every component; inside one they need not be all the pairs that qualify.
    """
    rows = written(signatures(docs, doc_id, text), "signatures")
    classes = written(rows.filter("n > 0").groupBy("cls", "check", "n")
                      .agg(F.min("id").alias("id"), F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "tag")).alias("member"),
                           F.first("bands").alias("bands"), F.first("mark").alias("mark")), "classes")
    banded = classes.select("cls", F.explode("bands").alias("key"))
    ends = (banded.groupBy("key").agg(F.count("*").alias("size"), F.min("cls").alias("low"), F.max("cls").alias("high"))
            .filter("size > 1").select(F.col("key").alias("own"), "low", "high"))
    buckets = written(banded.join(ends, F.col("key") == F.col("own")).drop("own"), "buckets")
    stars = (buckets.select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("cls").alias("b")),
                                              F.struct(F.col("cls").alias("a"), F.col("high").alias("b")))).alias("p"))
             .select("p.*").filter("a < b").distinct())
    likely = written(_promising(stars, classes, percent), "pairs")
    wanted = classes.join(buckets.select("cls").distinct(), "cls", "left_semi").select("member.id", "member.tag", "cls")
    sets = written(_sets(docs, wanted, doc_id, text), "sets")
    first = written(_linked(likely, sets, percent), "links")

    roots = components(first)
    rooted = written(buckets.select("key", "cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
                     .withColumn("root", F.coalesce("root", "cls")), "rooted")
    marked = _pieced(rooted).join(classes.select("cls", "mark", "bands"), "cls").repartition(*PIECE).sortWithinPartitions(*PIECE)
    flagged = written(marked.mapInPandas(_hopeful(percent), "key long, main boolean, i long, j long, side int, cls long, root long"), "hopeful")
    whole = flagged.join(sets, "cls").repartition(*PIECE).sortWithinPartitions(*PIECE)
    second = written(whole.mapInPandas(_spanning(percent), "a long, b long").distinct(), "links")
    return rows, classes, first.unionByName(second)


def near_duplicates(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: id, tag, n (set size), cls, component (smallest id reachable, null last), keeper.

    keeper is the id and tag of the document that stands for the component: that with the
    smallest id, null last, then the smallest tag. Null ids are ids of their own here: such
    documents are linked like others, and a component of them only has a null id.
    """
    rows, classes, found = links(docs, percent, doc_id, text)
    roots = components(found)
    placed = (classes.select("cls", "check", "n", "id", "member").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
              .withColumn("root", F.coalesce("root", "cls")))
    least = placed.groupBy("root").agg(F.min("id").alias("component"), F.min("member").alias("keeper"))
    known = written(placed.join(least, "root").select(F.col("cls").alias("c"), F.col("check").alias("k"), "component", "keeper"), "components")
    same = (F.col("cls") == F.col("c")) & (F.col("check") == F.col("k"))
    return (rows.select("id", "tag", "n", "cls", "check").join(known, same, "left")
            .select("id", "tag", "n", "cls", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"), "keeper"))


def keep_one(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` of which each near-duplicate group keeps one: that with its smallest id, null last.

    Texts without words are in no group and all stay. Rows that repeat id (or its absence) and
    text are one document: all of them stay or none.
    """
    found = near_duplicates(docs, percent, doc_id, text)
    stays = F.col("id").eqNullSafe(F.col("keeper.id")) & (F.col("tag") == F.col("keeper.tag"))
    gone = found.filter((F.col("n") > 0) & ~stays).select(F.col("id").alias("gone_id"), F.col("tag").alias("gone_tag"))
    rows = docs.select(whole_row(docs).alias("row"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("tag"))
    return rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("tag") == F.col("gone_tag")), "left_anti").select("row.*")

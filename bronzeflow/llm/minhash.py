"""Near duplicates by DartMinHash over word shingles.

Every element (a shingle, or the c-th copy of one) owns a region of unit weight.
Darts fall into it as a Poisson process in rank, drawn by hashing the element;
each dart also draws a coordinate of the signature. A coordinate keeps its
earliest dart, so two sets agree in it with the probability of their weighted
Jaccard similarity. Only the earliest darts of a whole set are ever thrown, a
number that does not grow with the set.

Bands of coordinates bring texts together in buckets. Within a bucket texts are
not compared all with all: each is compared with one pivot, classes that are
found merge, and only while a bucket still holds several classes does it get a
further pivot. A link is a true similarity of the shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bronzeflow.llm.common import free_name, release, scratch, whole_text
from bronzeflow.llm.hashing import mixed, word_hashes

WORDS = 5
SIMILARITY = 0.8
#: Bands and coordinates of a band: at similarity 0.8 a pair shares no band with
#: a probability under 1 in 200,000.
BANDS, ROWS = 24, 4
#: Texts hashed at once, in words and in number: each throws some 800 darts.
PIECE, AT_ONCE = 1 << 18, 1024
#: Darts that are held at once, of all sets together.
DARTS = 1 << 17


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] of 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)


def shingle_sets(texts: list[bytes], n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted within a text; and the text of each.

    A text of fewer words than a shingle is one shingle of all its words; one
    without words has none.
    """
    flat, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(flat)) - np.repeat(ends - counts, counts)
    size = np.minimum(counts, n)[owner]
    starts = np.flatnonzero(place <= counts[owner] - size)
    value = np.zeros(len(starts), dtype=np.uint64)
    size = size[starts]
    for k in range(n):
        inside = k < size
        following = flat[np.minimum(starts + k, max(len(flat) - 1, 0))]
        value = np.where(inside, mixed(value ^ following, k + 1), value)
    order = np.lexsort((value, owner[starts]))
    value, owner = value[order], owner[starts][order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], owner[new]


def signatures(
    elements: np.ndarray, owner: np.ndarray, n_sets: int, coordinates: int
) -> np.ndarray:
    """Earliest dart per coordinate of each set, as a number that names the dart.

    ``elements`` are the hashes of unit regions. Ranks are cut where a set has
    about ``coordinates * (log(coordinates) + 4)`` darts; a set that leaves a
    coordinate empty goes on to twice the rank until none is.
    """
    best = np.full((n_sets, coordinates), np.inf)
    name = np.zeros((n_sets, coordinates), dtype=np.uint64)
    sizes = np.bincount(owner, minlength=n_sets)
    darts = coordinates * (np.log(coordinates) + 4)
    limit = np.where(sizes > 0, darts / np.maximum(sizes, 1), 0.0)
    todo = sizes > 0
    while todo.any():
        live = np.flatnonzero(todo[owner])
        rank, salt = np.zeros(len(live)), 1
        thrown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while live.size:
            draw = mixed(elements[live], salt)
            rank = rank - np.log(uniform(draw))
            inside = rank <= limit[owner[live]]
            live, rank, draw = live[inside], rank[inside], draw[inside]
            cell = owner[live] * coordinates + (mixed(draw, 0) % np.uint64(coordinates)).astype(np.int64)
            thrown.append((cell, rank, draw))
            salt += 1
            if not live.size or sum(len(x) for x, _, _ in thrown) >= DARTS:
                _land(thrown, best.ravel(), name.ravel())
                thrown = []
        todo &= np.isinf(best).any(axis=1)
        limit = np.where(todo, limit * 2, limit)
    return name


def _land(
    thrown: list[tuple[np.ndarray, np.ndarray, np.ndarray]], best: np.ndarray, name: np.ndarray
) -> None:
    """Enter darts ``(cell, rank, draw)`` where none earlier is; of equal ranks the last stays."""
    cell, rank, draw = (np.concatenate(x) for x in zip(*thrown))
    order = np.argsort(-rank, kind="stable")  # the earliest is written last
    order = order[rank[order] <= best[cell[order]]]
    best[cell[order]] = rank[order]
    name[cell[order]] = draw[order]


def band_hashes(texts: list[bytes], bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each band of each text, in a row per text; and the sizes of their sets."""
    elements, owner = shingle_sets(texts)
    name = signatures(elements, owner, len(texts), bands * rows)
    parts = name.reshape(len(texts), bands, rows)
    value = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(texts), bands)).copy()
    for k in range(rows):
        value = mixed(value ^ parts[:, :, k], k + 11)
    return value.view(np.int64), np.bincount(owner, minlength=len(texts))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``(id, class_id, text_class, copies)``, one row per input row.

    ``class_id`` is the smallest id of all texts that links join, directly or
    through others: a link is a Jaccard similarity of the sets of five-word
    shingles of at least ``similarity``. ``text_class`` is the smallest id with
    just this text, and ``copies`` the number of rows with it.

    * Texts of one to four words are one shingle of all their words, so they
      link to equal word sequences only. Null and empty texts, and those of
      white space, have no shingles and link to exact copies only (null: empty).
    * Equal ids with different texts are in the class of each. Null ids count as
      the largest. An empty table gives no rows. No other columns are looked at.
    """
    signed, named = _named(docs, id_col, text_col, similarity, bands, rows)
    named = named.select("text_key", "class_id", "text_class", "copies")
    back = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return signed.select("id", "text_key").join(named, "text_key").select(
        back("id").alias(id_col),
        back("class_id").alias("class_id"),
        back("text_class").alias("text_class"),
        "copies",
    )


def _named(
    docs: DataFrame, id_col: str, text_col: str, similarity: float, bands: int, rows: int
) -> tuple[DataFrame, DataFrame]:
    """``(id, text_key, bands)`` of the rows, and of each text
    ``(text_key, text_class, copies, class_id, leader)``, the leader being the text of
    its class that has the smallest id."""
    signed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        whole_text(text_col).alias("text"),
    ).mapInArrow(
        _signer(bands, rows), "id long, text_key binary, set_size long, bands array<long>"
    )
    signed = scratch(signed, "minhash-signatures")
    texts = signed.groupBy("text_key").agg(
        F.min("id").alias("text_class"),
        F.count(F.lit(1)).alias("copies"),
        F.first("set_size").alias("set_size"),
        F.first("bands").alias("bands"),
    )
    texts = scratch(texts, "minhash-texts")
    # A text's key stands for it from here on: ids may be shared by several.
    members = texts.select("text_key", "set_size", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = F.sum("n").over(Window.partitionBy("text_key")).alias("crowd")
    members = scratch(
        members.join(shared, "band").select("band", "text_key", "set_size", met), "minhash-members"
    )
    involved = members.select("text_key").distinct()
    keyed = docs.select(whole_text(text_col).alias("text")).withColumn(
        "text_key", _key(F.col("text"))
    )
    # One copy of each text before anything meets by key.
    bodies = keyed.groupBy("text_key").agg(F.first("text").alias("text"))
    bodies = bodies.join(involved, "text_key", "left_semi")
    bodies = scratch(
        bodies.mapInArrow(_shingler(), "text_key binary, shingles binary"), "minhash-shingles"
    )
    release(docs.sparkSession)
    classes = _merge(members, bodies, similarity)
    named = (
        texts.join(classes, "text_key", "left")
        .withColumn("root", F.coalesce("root", "text_key"))
        .select("text_key", "text_class", "copies", "root")
    )
    smallest = named.groupBy("root").agg(F.min(F.struct("text_class", "text_key")).alias("least"))
    return signed, named.join(smallest, "root").select(
        "text_key",
        "text_class",
        "copies",
        F.col("least.text_class").alias("class_id"),
        F.col("least.text_key").alias("leader"),
    )


NO_ID = int(np.iinfo(np.int64).max)


def _key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _merge(members: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """``(text_key, root)`` of the texts that have a link.

    In a bucket the class with most members is its core. Every round some texts
    outside the core are pivots, eight times as many as in the round before: first
    the one that meets most others in all its buckets, which of near copies is
    likely their original. They are compared with the texts of all other classes. Texts that were pivots have
    met everything, and a bucket is done when all outside its core were. So every
    pair of different classes that shares a band has been compared, while a
    group of near copies, of any size, is mostly joined by its first pivot.
    """
    spark = members.sparkSession
    own = F.col("text_key").alias("root")
    state = members.select("band", "text_key", "set_size", "crowd", own, F.lit(False).alias("used"))
    roots = members.select("text_key", own).distinct()
    n = 0
    while True:
        waiting = state.where("NOT used")
        sizes = state.groupBy("band", "root").agg(F.count(F.lit(1)).alias("size"))
        cores = sizes.groupBy("band").agg(F.max_by("root", F.struct("size", "root")).alias("core"))
        outside = waiting.join(cores, "band").where("root != core")
        left = outside.groupBy("band").agg(
            F.count(F.lit(1)).alias("left"),
            F.max(F.struct("crowd", _turn(n), F.col("text_key").alias("key"))).alias("first"),
        )
        # So many besides the first, by chance; at most a few hundred a round.
        chance = (_turn(n).bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)) * F.col("left")
        chosen = outside.join(left, "band").where(
            (F.col("text_key") == F.col("first.key")) | (chance < min(8**n, 512) - 1)
        )
        pivots = scratch(
            chosen.select("band", F.col("text_key").alias("pivot"), F.col("root").alias("pivot_root")),
            "minhash-pivots",
        )
        if pivots.isEmpty():
            break
        links = _compared(waiting, pivots, bodies, similarity)
        new = components(scratch(links.distinct(), "minhash-links"))
        release(spark)
        of_band = pivots.groupBy("band").agg(F.collect_set("pivot").alias("pivots"))
        state = state.join(of_band, "band").select(  # the other buckets are done
            "band",
            "text_key",
            "set_size",
            "crowd",
            "root",
            (F.col("used") | F.array_contains("pivots", F.col("text_key"))).alias("used"),
        )
        state = scratch(_renamed(state, new), "minhash-state")
        # Written every round, so that the plan does not grow with the rounds.
        roots = scratch(_renamed(roots, new), "minhash-roots")
        n += 1
    return roots


def _renamed(df: DataFrame, maps: list[DataFrame]) -> DataFrame:
    """``df`` with its roots led through the maps ``(key, to)``, one after another."""
    for step in maps:
        known = step.withColumnRenamed("key", "root")
        df = df.join(known, "root", "left").withColumn("root", F.coalesce("to", "root")).drop("to")
    return df


def _turn(n: int) -> Column:
    """Order of the texts of a bucket as pivots in a round."""
    return F.xxhash64("text_key", F.lit(n))


#: Texts of a bucket from which it is compared in tiles; texts of a tile, and
#: shingles of all its texts, on average.
LARGE, TILE, TILE_SHINGLES = 64, 512, 1 << 19


def _compared(
    waiting: DataFrame, pivots: DataFrame, bodies: DataFrame, similarity: float
) -> DataFrame:
    """``(root, pivot_root)`` of the pairs of text and pivot that are similar enough.

    In a small bucket each pair meets by itself. The texts of a large one are
    dealt into tiles, past each of which all pivots are streamed, so that a set is
    moved once per tile and not once per pair. A task holds the texts of one tile.
    """
    sizes = waiting.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("set_size").alias("shingles")
    )
    sized = pivots.join(sizes, "band")
    met = waiting.join(sized.where(f"n <= {LARGE}"), "band").where("root != pivot_root")
    pairs = met.select(F.col("text_key").alias("a"), F.col("pivot").alias("b"), "root", "pivot_root")
    small = _linked(pairs.distinct(), bodies, similarity)

    # Never more tiles than texts.
    wanted = F.greatest(F.col("n") / TILE, F.col("shingles") / TILE_SHINGLES)
    tiles = F.least(F.ceil(wanted), F.col("n")).cast("int")
    open_ = sized.where(f"n > {LARGE}").select("band", tiles.alias("tiles")).distinct()
    texts = waiting.join(open_, "band").select(
        "band",
        F.pmod(F.xxhash64("text_key"), F.col("tiles")).cast("int").alias("tile"),
        F.lit(0).alias("side"),
        "text_key",
        "root",
    )
    heads = sized.where(f"n > {LARGE}").select(
        "band",
        F.explode(F.sequence(F.lit(0), tiles - 1)).alias("tile"),
        F.lit(1).alias("side"),
        F.col("pivot").alias("text_key"),
        F.col("pivot_root").alias("root"),
    )
    place = ["band", "tile", "side"]
    both = texts.unionByName(heads).join(bodies, "text_key").select(*place, "root", "shingles")
    streamed = both.repartition("band", "tile").sortWithinPartitions(*place)
    return small.unionByName(
        streamed.mapInArrow(_tiles(similarity), "root binary, pivot_root binary")
    )


class Tile:
    """Shingle sets of the texts of a tile, to which pivots are compared one by one."""

    def __init__(self) -> None:
        self.roots: list[bytes] = []
        self.sets: list[np.ndarray] = []
        self.flat: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def add(self, root: bytes, shingles: bytes) -> None:
        self.roots.append(root)
        self.sets.append(np.frombuffer(shingles, dtype=np.uint64))

    def near(self, shingles: bytes, similarity: float) -> set[bytes]:
        """Roots of the texts that are similar enough to a pivot."""
        own = np.frombuffer(shingles, dtype=np.uint64)
        if not self.roots or not len(own):
            return set()
        if self.flat is None:
            sizes = np.array([len(x) for x in self.sets], dtype=np.int64)
            owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            self.flat, self.sets = (np.concatenate(self.sets), owner, sizes), []
        every, owner, sizes = self.flat
        at = np.minimum(np.searchsorted(own, every), len(own) - 1)
        common = np.bincount(owner[own[at] == every], minlength=len(sizes))
        found = (common > 0) & (common >= similarity * (sizes + len(own) - common) - 1e-9)
        return {self.roots[i] for i in np.flatnonzero(found)}


def _tiles(similarity: float):
    """Links between texts and pivots of rows ``(band, tile, side, root, shingles)`` in
    order: of every tile first the texts, then the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tile = None, Tile()
        for batch in batches:
            found: set[tuple[bytes, bytes]] = set()
            bands, numbers, sides = (batch.column(c).to_pylist() for c in range(3))
            for i, (place, side) in enumerate(zip(zip(bands, numbers), sides)):
                if place != current:
                    current, tile = place, Tile()
                root, shingles = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
                if side == 0:
                    tile.add(root, shingles)
                else:
                    found |= {(r, root) for r in tile.near(shingles, similarity) if r != root}
            pairs = sorted(found)
            columns = [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["root", "pivot_root"])

    return run


def _linked(pairs: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """``(root, pivot_root)`` of the pairs whose shingle sets are similar enough."""
    left = bodies.withColumnsRenamed({"text_key": "a", "shingles": "left"})
    right = bodies.withColumnsRenamed({"text_key": "b", "shingles": "right"})
    both = pairs.join(left, "a").join(right, "b").select("root", "pivot_root", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in (2, 3)
                )
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common > 0 and common >= similarity * (len(x) + len(y) - common) - 1e-9)
            yield batch.filter(pa.array(keep)).select([0, 1])

    return both.mapInArrow(run, "root binary, pivot_root binary")


def components(links: DataFrame) -> list[DataFrame]:
    """Maps ``(key, to)`` that lead, one after another, each end of a link to its component.

    Every round each node goes to the smallest of itself and its neighbours, and
    the links are drawn anew between where their ends went. A star is one point
    after two rounds, and what is left shrinks by a factor each time.
    """
    maps = []
    links = links.toDF("a", "b")
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("to"))
        least = least.where("to < key")
        maps.append(scratch(least, "minhash-map"))
        ends = maps[-1]
        moved = (
            links.join(ends.toDF("a", "x"), "a", "left")
            .join(ends.toDF("b", "y"), "b", "left")
            .select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
        )
        links = scratch(moved.where("a != b").distinct(), "minhash-moved")
    return maps


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: float) -> DataFrame:
    """One document of each class stays, with its own columns: that of the smallest id.

    Of repeated rows of that id and text one stays.
    """
    key, own = free_name(docs, "near_key"), free_name(docs, "near_id")
    settings = {"similarity": SIMILARITY, "bands": BANDS, "rows": ROWS} | options
    _, named = _named(docs, id_col, text_col, **settings)
    leaders = named.where("text_key = leader").select(
        F.col("text_key").alias(key), F.col("text_class").alias(own)
    )
    marked = docs.withColumns(
        {
            key: _key(whole_text(text_col)),
            own: F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)),
        }
    )
    # Join and duplicates go by the same columns, so the texts are shuffled once.
    kept = marked.join(leaders, [key, own], "left_semi").dropDuplicates([key, own])
    return kept.select(*docs.columns)


def _signer(bands: int, rows: int):
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for part in parts_of(texts):
                own = [x.as_py() for x in texts.slice(part.start, part.stop - part.start)]
                found, sizes = band_hashes(own, bands, rows)
                empty = sizes == 0
                offsets = np.concatenate([[0], np.cumsum(np.where(empty, 0, bands))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[~empty].ravel()))
                keys = pa.array([hashlib.sha256(t).digest() for t in own], pa.binary())
                ids = batch.column(0).slice(part.start, len(own))
                columns = {"id": ids, "text_key": keys, "set_size": pa.array(sizes), "bands": lists}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _shingler():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for part in parts_of(texts):
                own = [x.as_py() for x in texts.slice(part.start, part.stop - part.start)]
                elements, owner = shingle_sets(own)
                cuts = np.searchsorted(owner, np.arange(len(own) + 1))
                sets = [elements[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                keys = batch.column(0).slice(part.start, len(own))
                yield pa.RecordBatch.from_arrays([keys, pa.array(sets, pa.binary())], ["text_key", "shingles"])

    return run


def parts_of(texts: pa.Array, most: int = 8 * PIECE) -> Iterator[slice]:
    """Stretches of about ``most`` bytes and at most ``AT_ONCE`` rows, one row at least."""
    ends = np.cumsum(np.asarray(pa.compute.binary_length(texts)).astype(np.int64))
    lo, base = 0, 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
        hi = min(hi, lo + AT_ONCE)
        yield slice(lo, hi)
        lo, base = hi, int(ends[hi - 1])

"""Order MinHash near-duplicate detection, verified by banded alignment.

Two texts are near duplicates if the edit similarity of their word sequences is ``SIMILARITY`` (0.8) or more: one less
the edit distance (words put in, taken out or replaced) by the length of the longer. Words are lower-cased runs of
ASCII letters and digits and of anything beyond ASCII. The distance is found by a banded, bit-parallel alignment, whose
band grows until it holds the alignment or passes what 0.8 allows.

Candidates come from order min-hash: a k-mer is a shingle of five words with its occurrence number, so that repeats
count. Each of 64 sketches takes the 2 k-mers of smallest hash, puts them back in text order and hashes them in that
order: texts share a sketch with a probability near ``J ** 2`` (``J``: Jaccard similarity of the k-mers), and only if
the shared k-mers stand in the same order. Replacing one word in ten leaves ``J`` near 0.42, and no chance in 100,000 to share none of 64 sketches; one word in
five, the threshold, leaves 0.2, and a chance of 8 in a hundred. Texts of at most ``SHORT`` shingles get
``SHORT_SKETCHES`` more of half as many k-mers, because few k-mers of a short text survive an edit. (For longer texts such sketches
gather all that share a passage.)

Plan, without pairs within a group:

1. Exact copies meet by a 128-bit hash of the text; one text of each goes on, with its sketches and its bag: the
   counts of its words in 256 bins. Of several buckets that hold the same texts one is read. A word put in, taken out or replaced changes the surplus of one bag over another by
   one at most, so bags that differ by more than the allowed distance rule a pair out, as lengths do.
2. A bucket of a sketch with at most ``LIMIT`` texts is one small group: its leader (the text whose buckets are the
   largest in sum: in a family of copies the original or nearest to it) meets all that bags don't rule out, a text that
   was ruled out leads the rest, and so on; fewer pairs than texts. In a larger bucket all meet the first leader.
3. The pair with each text's most popular leader is aligned first; pairs whose ends are connected by then need no
   alignment.
4. Where a small bucket then still holds texts of several components, its texts are aligned across them, nearest bags
   first, until they are connected or no pair is left that bags don't rule out; only links come out. A pair is left to
   the first small bucket that it shares.
5. Texts of larger buckets that hold several components (texts with a passage in common, say) are sketched anew by twice
   as many k-mers (and, from the second time on, twice as many sketches), which parts them, and go through steps 2 to 4 again; each of ``TIERS``
   tiers at most, which joins most of what belongs together. Texts of a large bucket that are of several components even
   then are compared across them, in blocks of ``LIMIT`` texts of like length, so that no pair that shares a bucket is left
   out, whatever it shares in later tiers; only that work grows with the square of such a bucket.
6. Links (never collected) are joined to components: those to leaders are trees, whose nodes find their roots by
   pointer jumping; later links join such components by alternating large-star and small-star steps, each written to the
   shared folder.

Sketching is one map over the documents (mapInArrow); alignment a map over candidate pairs with their texts, joined
by Spark. Whatever may hold a hot key (a leader, a hub of links) is joined to a written table with one row a key, so
that adaptive execution splits it. Counts and minima combine before they shuffle.

Edge cases: texts that are equal are one class, empty ones too, and texts without words otherwise stay alone. Texts of
under five words are one shingle. Texts that share no shingle of five words are no candidates. A null text is a class of its own row. Rows that repeat id and text are one document of the class. Rows
that repeat an id with another text are told apart by their text. Null ids are ids, the smallest. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_path, stored, table

K = 5
SIMILARITY = 0.8
KEPT, SKETCHES, TIERS = 2, 64, 4
SHORT, SHORT_SKETCHES = 64, 12
LIMIT = 4096
BAG = 256
BITS = 1 << 24
_CELLS = 1 << 16
_CACHED_WORDS = 2_000_000
_FINE = 2048
_RANDOM = np.random.default_rng(20240229)
_FUNCTIONS = 1024
_MULTIPLIERS = _RANDOM.integers(1, 1 << 63, _FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RANDOM.integers(1, 1 << 63, _FUNCTIONS, dtype=np.uint64)
_WORD_BYTES = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_AT_ONCE = 1 << 18  # hashes, of some functions of all k-mers
_FIRST_BAND = 16
_NODE = "struct<id:bigint,h:bigint>"


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def word_codes(text: str) -> np.ndarray:
    """A 32-bit code of each word."""
    words = words_of(text)
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` words; a shorter text is one shingle."""
    if not len(codes):
        return np.zeros(0, np.uint64)
    k = min(k, len(codes))
    out = np.zeros(len(codes) - k + 1, np.uint64)
    for i in range(k):
        out = (out + codes[i : i + len(out)] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return _mixed(out)


def _labelled(shingles: np.ndarray) -> np.ndarray:
    """Each shingle with the number of its occurrence, as a hash."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    at = np.arange(len(ranked), dtype=np.uint64)
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    out = np.empty_like(shingles)
    out[order] = _mixed(ranked + number * np.uint64(0xD1B54A32D192ED03))
    return out


def _ordered_minima(labelled: np.ndarray, shingles: np.ndarray, first: int, count: int, kept: int) -> list[int]:
    out: list[int] = []
    step = max(1, min(count, _AT_ONCE // len(labelled)))
    for j in range(first, first + count, step):
        keys = labelled[None, :] * _MULTIPLIERS[j : j + step, None] + _ADDENDS[j : j + step, None]
        if keys.shape[1] <= kept:
            places = np.broadcast_to(np.arange(keys.shape[1]), keys.shape)
        elif kept <= 2:
            rows = np.arange(len(keys))
            places = keys.argmin(axis=1)[:, None]
            if kept == 2:
                keys[rows, places[:, 0]] = np.uint64(0xFFFFFFFFFFFFFFFF)
                places = np.sort(np.concatenate([places, keys.argmin(axis=1)[:, None]], axis=1), axis=1)
        else:
            places = np.sort(np.argpartition(keys, kept - 1, axis=1)[:, :kept], axis=1)
        value = np.full(len(keys), kept, np.uint64)
        for column in shingles[places].T:
            value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + column)
        out += value.view(np.int64).tolist()
    return out


def _tier(tier: int) -> tuple[int, int, int]:
    """The k-mers and the number of sketches of a tier, and the first of its hash functions."""
    sketches = [max(SKETCHES, SKETCHES // 2 << t) for t in range(tier + 1)]
    return KEPT << tier, sketches[-1], sum(sketches[:-1]) + SHORT_SKETCHES * tier


def sketches_of(codes: np.ndarray, tier: int = 0) -> list[int]:
    """The order-min-hash sketches of a word sequence."""
    shingles = shingle_hashes(codes)
    if not len(shingles):
        return []
    labelled = _labelled(shingles)
    kept, count, first = _tier(tier)
    out = _ordered_minima(labelled, shingles, first, count, kept)
    if len(shingles) <= SHORT:
        out += _ordered_minima(labelled, shingles, first + count, SHORT_SKETCHES, kept // 2)
    return out


def bag_of(codes: np.ndarray, bins: int = BAG) -> bytes:
    """How many words fall in each bin, 255 at most: what is cut off can only bring two bags nearer."""
    return np.minimum(np.bincount((codes & np.uint64(bins - 1)).astype(np.int64), minlength=bins), 255).astype(np.uint8).tobytes()


def _sketcher(tier: int):
    """From (doc_id, h1, h2, text); the first three pass through."""

    def sketch(batches):
        for batch in batches:
            lengths, bags, sketches = [], [], []
            for text in batch.column(3):  # one text at a time
                codes = word_codes(text.as_py() or "")
                lengths.append(len(codes))
                bags.append(bag_of(codes))
                sketches.append(sketches_of(codes, tier))
            made = [pa.array(lengths, pa.int32()), pa.array(bags, pa.binary()), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=["doc_id", "h1", "h2", "n", "bag", "sketches"])

    return sketch


_SKETCHED = "doc_id long, h1 long, h2 long, n int, bag binary, sketches array<long>"


# -- alignment ---------------------------------------------------------------------


def _banded(a: list, b: list, band: int, most: int) -> int:
    """The edit distance over cells at most ``band`` off the diagonal; ``most + 1`` as soon as it is more.

    Bit ``p`` of a column ``j`` is row ``j - band + p``, so each step works on ``2 * band + 1`` bits. The distance is
    followed down the diagonal that ends in the last cell, where it never falls. Rows above the first rise towards it
    by one a row, so that they never offer a shorter way.
    """
    width = 2 * band + 1
    full, end = (1 << width) - 1, 1 << (len(a) - len(b) + band)
    masks: dict = {}
    for i, x in enumerate(a, band):  # a row's bit in blocks as wide as the window, which meets two of them
        key = (x, i // width)
        masks[key] = masks.get(key, 0) | 1 << i % width
    down = (1 << band) - 1
    up, distance = full ^ down, abs(len(a) - len(b))
    get = masks.get
    block, shift = 0, 0
    for x in b:
        match = get((x, block), 0) >> shift | get((x, block + 1), 0) << (width - shift) & full
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        right_up = down | (full ^ (diagonal | up))
        right_down = diagonal & up
        if not diagonal & end:
            distance += 1
            if distance > most:
                return distance
        diagonal >>= 1
        up, down = right_down | (full ^ (diagonal | right_up)), diagonal & right_up
        shift += 1
        if shift == width:
            block, shift = block + 1, 0
    return distance


def edit_distance(a: list, b: list, most: int) -> int | None:
    """The edit distance of two sequences if it is ``most`` or less; the band widens until it holds the alignment."""
    start, end, least = 0, 0, min(len(a), len(b))
    while start < least and a[start] == b[start]:
        start += 1
    while end < least - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    longer, apart = max(len(a), len(b)), abs(len(a) - len(b))
    if apart > most:
        return None
    if not a or not b:
        return longer
    if longer - sum((Counter(a) & Counter(b)).values()) > most:
        return None
    band = max(apart, _FIRST_BAND)
    while True:
        band = min(band, most)
        found = _banded(a, b, band, band)
        if found <= band:
            return found
        if band == most:
            return None
        band *= 4


def similarity(a: list, b: list, least: float = SIMILARITY) -> float | None:
    """Edit similarity of two word sequences, None if it is under ``least`` or one has no word."""
    if not a or not b:
        return None
    longer = max(len(a), len(b))
    found = edit_distance(a, b, int((1 - least) * longer + 1e-9))
    return None if found is None else 1 - found / longer


class _Reader:
    """Word codes and fine bags of texts, some of them held."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.words = 0

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found = self.known.get(text)
        if found is None:
            if self.words > _CACHED_WORDS:
                self.known.clear()
                self.words = 0
            codes = word_codes(text)
            found = self.known[text] = codes, np.frombuffer(bag_of(codes, _FINE), np.uint8)
            self.words += len(codes) + _FINE
        return found

    def similarity(self, a: str, b: str, least: float) -> float | None:
        (x, of_x), (y, of_y) = self(a), self(b)
        if _room(np.array(len(x)), of_x, np.array(len(y)), of_y, least) < 0:
            return None
        return similarity(x.tolist(), y.tolist(), least)


def _verifier(least: float):
    def verify(batches):
        reader = _Reader()
        for batch in batches:
            found = [reader.similarity(a, b, least) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    return verify


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) with their similarity, null under ``least``."""
    with_b = pairs.select("a", "b").join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    with_a = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return with_a.select("a", "b", "text_a", "text_b").mapInArrow(_verifier(least), f"a {_NODE}, b {_NODE}, similarity double")


# -- candidates ---------------------------------------------------------------------


def _bags(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BAG)


def _room(n: np.ndarray, bags: np.ndarray, m: np.ndarray, others: np.ndarray, least: float) -> np.ndarray:
    """By how many edits lengths and bags stay under what ``least`` allows, -1 if beyond; the last axis of the bags is the bin."""
    longer, shorter = np.maximum(n, m), np.minimum(n, m)
    # the surplus of one bag over the other is what both hold at most, less what the other holds
    together = np.maximum(bags, others).sum(axis=-1, dtype=np.uint32 if bags.shape[-1] > BAG else np.uint16).astype(np.int32)
    fewest = np.minimum(bags.sum(axis=-1, dtype=np.int32), others.sum(axis=-1, dtype=np.int32))
    most = np.floor((1 - least) * longer + 1e-9).astype(np.int32)
    return np.where((shorter > 0) & (shorter >= least * longer - 1e-9), np.maximum(most - (together - fewest), -1), -1)


def _rooms(n: np.ndarray, bags: np.ndarray, of: np.ndarray, least: float) -> np.ndarray:
    """``_room`` of some texts of a bucket with all of it, some rows at a time; a text has none with itself."""
    room = np.empty((len(of), len(n)), np.int32)
    step = max(1, _CELLS // len(n))
    for at in range(0, len(of), step):
        some = of[at : at + step]
        room[at : at + step] = _room(n[some, None], bags[some, None], n[None], bags[None], least)
    room[np.arange(len(of)), of] = -1
    return room


def _row_filter(least: float):
    """Keeps pairs (a, b, less, n_a, n_b, bag_a, bag_b) that may align."""

    def keep(batches):
        for batch in batches:
            near = _room(np.asarray(batch.column(3)), _bags(batch.column(5)), np.asarray(batch.column(4)), _bags(batch.column(6)), least) >= 0 if batch.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(near, pa.bool_())) for c in batch.columns[:3]], names=["a", "b", "less"])

    return keep


def _buckets(batches):
    """The rows (band, value, ...) of one bucket after the other; rows come sorted by bucket."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        keys = np.stack([np.asarray(batch.column(0)).astype(np.int64), np.asarray(batch.column(1))])
        begins = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]).tolist()
        yield batch, list(zip(begins[:-1], begins[1:]))
        held = batch.slice(begins[-1])  # the last bucket may go on; it has at most LIMIT texts
    if held is not None:
        yield held, [(0, held.num_rows)]


def _leaders(least: float):
    """For rows (band, value, less, node, n, bag): pairs of a bucket with its leaders in turn, and texts without a pair that have a possible partner."""

    def lead(batches):
        for rows, buckets in _buckets(batches):
            n, bags = np.asarray(rows.column(4)), _bags(rows.column(5))
            left: list[int] = []
            right: list[int | None] = []
            twos = np.array([i for i, j in buckets if j - i == 2], int)
            near = twos[_room(n[twos], bags[twos], n[twos + 1], bags[twos + 1], least) >= 0].tolist()
            left += near
            right += [i + 1 for i in near]
            for i, j in buckets:
                if j - i > 2:
                    for x, y in _led(n[i:j], bags[i:j], least):
                        left.append(i + x)
                        right.append(None if y is None else i + y)
            at, to = pa.array(left, pa.int64()), pa.array(right, pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column(3).take(at), rows.column(3).take(to), rows.column(2).take(at)], names=["a", "b", "less"])

    return lead


def _led(n: np.ndarray, bags: np.ndarray, least: float) -> list[tuple[int, int | None]]:
    out: list[tuple[int, int | None]] = []
    free = np.ones(len(n), bool)
    for i in range(len(n)):
        if free[i]:
            free[i] = False
            near = _rooms(n, bags, np.array([i]), least)[0] >= 0
            found = np.flatnonzero(near & free)
            free[found] = False
            out += [(i, x) for x in found.tolist()] if len(found) or not near.any() else [(i, None)]
    return out


def _across(rows: pa.RecordBatch, least: float) -> list[tuple[int, np.ndarray]]:
    """For a bucket of rows (.., node, n, bag, label_id, label_h, places): each text with those of other components that may align.

    Texts of the largest component are only partners. The partners whose bags leave most room come first. A pair is left
    to the first of the small buckets that both are in (``places``: bands and values of each text's).
    """
    n, bags = np.asarray(rows.column(4)), _bags(rows.column(5))
    labels = np.stack([np.asarray(rows.column(6)), np.asarray(rows.column(7))], axis=1)
    _, label, size = np.unique(labels, axis=0, return_inverse=True, return_counts=True)
    label = label.reshape(-1)
    band, largest = rows.column(0)[0].as_py(), size.argmax()
    places = rows.column(8)
    owner = np.repeat(np.arange(len(n)), np.diff(np.asarray(places.offsets)))
    flat = places.flatten()
    bands, values = np.asarray(flat.field(0)), np.asarray(flat.field(1))
    early = bands < band
    table = np.zeros((len(n), band), np.int64)
    there = np.zeros((len(n), band), bool)
    table[owner[early], bands[early]], there[owner[early], bands[early]] = values[early], True
    out = []
    for i in range(len(n)):
        if label[i] == largest:
            continue
        room = _rooms(n, bags, np.array([i]), least)[0]
        found = np.flatnonzero((room >= 0) & (label != label[i]) & ((label == largest) | (np.arange(len(n)) > i)))
        found = found[~((table[found] == table[i]) & there[found] & there[i]).any(axis=1)]
        if len(found):
            out.append((i, found[np.argsort(-room[found], kind="stable")]))
    return out


def _askers(least: float):
    """The rows that take part in a possible pair across components."""

    def ask(batches):
        for rows, buckets in _buckets(batches):
            wanted = np.zeros(rows.num_rows, bool)
            for i, j in buckets:
                for x, found in _across(rows.slice(i, j - i), least):
                    wanted[i + x] = wanted[i + found] = True
            yield rows.filter(pa.array(wanted))

    return ask


def _joiner(least: float):
    """Links that join the components of a bucket, from rows with the text last; what is connected isn't aligned."""

    def join(batches):
        reader = _Reader()
        for rows, buckets in _buckets(batches):
            left, right, similarities = [], [], []
            for i, j in buckets:
                part = rows.slice(i, j - i)
                texts, labels = part.column(9), list(zip(part.column(6).to_pylist(), part.column(7).to_pylist()))
                root = {x: x for x in labels}

                def find(x):
                    while root[x] != x:
                        x = root[x]
                    return x

                for x, found in _across(part, least):
                    for y in found.tolist():
                        if find(labels[x]) != find(labels[y]) and (similar := reader.similarity(texts[x].as_py(), texts[y].as_py(), least)) is not None:
                            root[find(labels[x])] = find(labels[y])
                            left.append(i + x)
                            right.append(i + y)
                            similarities.append(similar)
            yield pa.RecordBatch.from_arrays([rows.column(3).take(pa.array(left, pa.int64())), rows.column(3).take(pa.array(right, pa.int64())), pa.array(similarities, pa.float64())], names=["a", "b", "similarity"])

    return join


_PAIRS = f"a {_NODE}, b {_NODE}, less long"


def _by_bucket(members: DataFrame) -> DataFrame:
    return members.repartition("band", "value").sortWithinPartitions("band", "value", "less", "node")


# -- components ---------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """Nodes ``node`` with the smallest node ``label`` of their component, for links (a, b) of orderable ids.

    Alternates small-star and large-star; each pass groups by node and writes its links, until no node is both a
    centre and a leaf. Minima are written before they are joined: links of a hub then meet one row of a plain table,
    and adaptive execution can split them.
    """
    spark = links.sparkSession
    edges = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    paths: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        out, path = stored(df, name)
        paths.append(path)
        return out

    edges = keep(edges, "links")
    while True:
        # small star: a node and its smaller neighbours are linked to the smallest of them
        lower = keep(edges.groupBy("b").agg(F.min("a").alias("m")), "least")
        small = edges.join(lower, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        done, edges = paths[:], keep(small, "links")
        if edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            break
        # large star: every larger neighbour of a node is linked to the node's smallest neighbour
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = keep(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        edges = keep(edges.join(least, "a").select(F.col("m").alias("a"), "b").where("a != b"), "links")
        for path in done:
            drop_path(spark, path)
            paths.remove(path)
    for path in paths[:-1]:
        drop_path(spark, path)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label"))


def rooted(links: DataFrame, keep) -> DataFrame:
    """Nodes ``node`` with ``label``, the root of their tree, for links from each node b to one a; by pointer jumping."""
    trees = keep(links.select(F.col("b").alias("node"), F.col("a").alias("label")), "trees")
    while True:
        up = trees.select(F.col("node").alias("label"), F.col("label").alias("up"))
        if trees.join(up, "label", "left_semi").isEmpty():
            return trees
        trees = keep(trees.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "trees")


def merged(labels: DataFrame, links: DataFrame, keep) -> DataFrame:
    """Labels of components once links (a, b) join some of them; a node without a label is its own."""
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"of_{end}"))
    edges = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).where("a != b")
    edges = keep(edges.distinct(), "edges")
    if edges.isEmpty():
        return labels
    roots = keep(components(edges), "roots")
    moved = labels.join(roots.select(F.col("node").alias("label"), F.col("label").alias("up")), "label", "left").select("node", F.coalesce("up", "label").alias("label"))
    return keep(moved.union(roots), "labels")


# -- the whole ---------------------------------------------------------------------


def _texts_of(nodes: DataFrame, keyed: DataFrame) -> DataFrame:
    """The texts of the nodes (column ``node``), and of few others, one row a node.

    A bitmap of ``BITS`` hashed nodes (2 MB at most, whatever their number) goes to the scan of the documents, so that
    texts that nobody asks for don't shuffle; the joins that follow are exact.
    """
    place = lambda: F.pmod(F.xxhash64("node"), F.lit(BITS)).alias("place")
    bits = nodes.select(place()).groupBy(F.expr("shiftright(place, 6)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
    found = keyed.where(F.col("text").isNotNull()).select(F.struct(F.col("doc_id").alias("id"), F.col("h1").alias("h")).alias("node"), "text", "h1", "h2")
    found = found.select("*", place()).withColumn("word", F.expr("shiftright(place, 6)")).join(F.broadcast(bits), "word")
    return found.where("shiftrightunsigned(bits, cast(place & 63 as int)) & 1 = 1").select("node", "text", "h1", "h2").dropDuplicates(["node"])


def _links(texts: DataFrame, keyed: DataFrame, links: DataFrame | None, labels: DataFrame | None, tier: int, least: float, tiers: int, keep) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, similarity) among ``texts`` (node, n, bag, sketches) and those known before, and the labels of their components."""
    members = texts.select("node", F.posexplode("sketches").alias("band", "value"))
    # buckets of the same texts (most buckets of a family of few) say the same: all count for popularity, one of them is read on
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"mark{seed}") for seed in (1, 2)]
    buckets = members.groupBy("band", "value").agg(F.count("*").alias("size"), *marks).where("size > 1")
    same = Window.partitionBy("size", "mark1", "mark2")  # at most one bucket a sketch
    place = F.struct("band", "value")
    buckets = keep(buckets.withColumn("read", F.min(place).over(same) == place).drop("mark1", "mark2"), "buckets")
    entries = F.collect_list(F.when(F.col("read"), F.struct("band", "value", "size"))).alias("entries")
    nodes = members.join(buckets, ["band", "value"]).groupBy("node").agg((-F.sum("size")).alias("less"), entries)
    nodes = keep(nodes.join(texts.select("node", "n", "bag"), "node"), "nodes")  # at most one entry a sketch
    entry = F.explode("entries").alias("e")
    any_large = not buckets.where(F.col("size") > LIMIT).isEmpty()

    members = nodes.select("less", "node", "n", "bag", entry).where(F.col("e.size") <= LIMIT).select("e.band", "e.value", "less", "node", "n", "bag")
    found = _by_bucket(members).mapInArrow(_leaders(least), _PAIRS)
    if any_large:
        # many buckets of a family have one leader: pairs are counted once before bags come to them
        large = nodes.select("less", "node", "n", entry).where(F.col("e.size") > LIMIT).select("e.band", "e.value", "less", "node", "n")
        leaders = keep(large.groupBy("band", "value").agg(F.min(F.struct("less", "node", "n")).alias("lead")).select("band", "value", "lead"), "leaders")
        close = F.least("n", "lead.n") >= least * F.greatest("n", "lead.n") - 1e-9
        to_leader = large.join(leaders, ["band", "value"]).where((F.col("node") != F.col("lead.node")) & close)
        to_leader = to_leader.groupBy(F.col("lead.node").alias("a"), F.col("node").alias("b")).agg(F.min("lead.less").alias("less"))
        end = lambda of: nodes.select(F.col("node").alias(of), F.col("n").alias(f"n_{of}"), F.col("bag").alias(f"bag_{of}"))
        led = keep(end("a").join(leaders.select(F.col("lead.node").alias("a")).distinct(), "a", "left_semi"), "led")
        to_leader = to_leader.join(end("b"), "b").join(led, "a").select("a", "b", "less", "n_a", "n_b", "bag_a", "bag_b")
        found = found.union(to_leader.mapInArrow(_row_filter(least), _PAIRS))
    pairs = keep(found.groupBy("a", "b").agg(F.min("less").alias("less")), "pairs")
    source = keep(_texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).where("node IS NOT NULL"), keyed), "sources")
    pairs = pairs.where("b IS NOT NULL")

    # the most popular leader of each text first; what that connects needs no further alignment
    first = pairs.groupBy("b").agg(F.min(F.struct("less", "a")).alias("lead")).select(F.col("lead.a").alias("a"), "b")
    tried = keep(_verified(first, source, least), "first")
    new = tried.where("similarity IS NOT NULL")
    labels = rooted(new, keep) if labels is None else merged(labels, new, keep)  # leaders come first in order, so there is no ring
    links = new if links is None else links.union(new)

    if any_large:
        of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"of_{end}"))
        rest = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left")
        new = keep(_verified(rest.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")), source, least).where("similarity IS NOT NULL"), "rest")
        links, labels = links.union(new), merged(labels, new, keep)
    # buckets of several components: small ones are compared across them, the texts of others go to the next tier
    labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    marked = labelled.select("node", "label", entry).select("node", "label", "e.band", "e.value", "e.size")
    mixed = marked.groupBy("band", "value").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("band", "value")
    mixed = keep(marked.drop("label").join(keep(mixed, "mixed"), ["band", "value"]), "marked")
    # nodes of two components share mixed buckets only, so these are all the places to look for an earlier one
    within = mixed.groupBy("node").agg(F.collect_list(F.struct("band", "value", "size")).alias("entries"))  # at most one entry a sketch
    within = keep(labelled.drop("entries").join(within, "node"), "within")
    small = F.filter("entries", lambda x: x["size"] <= LIMIT)
    places = F.transform(small, lambda x: F.struct(x["band"].alias("band"), x["value"].alias("value"))).alias("places")
    flat = ["e.band", "e.value", "less", "node", "n", "bag", F.col("label.id").alias("label_id"), F.col("label.h").alias("label_h"), "e.size", "places"]
    members = within.select("less", "node", "n", "bag", "label", entry, places).select(*flat)
    small = members.where(F.col("size") <= LIMIT).drop("size")
    new = _joined(_by_bucket(small).mapInArrow(_askers(least), small.schema), source, least, keep)
    links, labels = links.union(new), merged(labels, new, keep)
    hot = mixed.where(F.col("size") > LIMIT)
    apart = hot.select("node").distinct()
    if not any_large or apart.isEmpty():
        return links, labels
    if tier + 1 < tiers:  # joins most of what belongs together; what it doesn't find is compared below
        again = _texts_of(apart, keyed).join(apart, "node", "left_semi")
        rows = again.select("node.id", "h1", "h2", "text").mapInArrow(_sketcher(tier + 1), _SKETCHED)
        rows = keep(rows.select(F.struct(F.col("doc_id").alias("id"), F.col("h1").alias("h")).alias("node"), "n", "bag", "sketches"), "texts")
        links, labels = _links(rows, keyed, links, labels, tier + 1, least, tiers, keep)
    of_node = labels.select(F.col("node").alias("of"), F.col("label").alias("now"))
    marked = hot.join(of_node, F.col("node") == F.col("of"), "left").select("node", "band", "value", F.coalesce("now", "node").alias("label"))
    still = keep(marked.groupBy("band", "value").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("band", "value"), "still")
    marked = keep(marked.join(still, ["band", "value"]), "hot")
    if marked.isEmpty():
        return links, labels
    early = marked.groupBy("node", "label").agg(F.collect_list(F.struct("band", "value")).alias("hot"))  # at most one entry a sketch
    members = within.select("less", "node", "n", "bag", places).join(early, "node").select("less", "node", "n", "bag", F.col("label.id").alias("label_id"), F.col("label.h").alias("label_h"), "places", "hot", F.explode("hot").alias("e"))
    cut = _cut_up(members.select("e.band", "e.value", *[c for c in members.columns if c != "e"]), least, _tier(tier)[1] + SHORT_SKETCHES, keep)
    asked = keep(_by_bucket(cut).mapInArrow(_askers(least), cut.schema), "asked")
    if asked.isEmpty():
        return links, labels
    new = _joined(asked, keep(_texts_of(asked.select("node").distinct(), keyed), "sources"), least, keep)
    return links.union(new), merged(labels, new, keep)


def _joined(rows: DataFrame, source: DataFrame, least: float, keep) -> DataFrame:
    """Links across the components of buckets; their texts come to their rows."""
    with_text = rows.join(source.select("node", "text"), "node").select(*rows.columns, "text")
    return keep(_by_bucket(with_text).mapInArrow(_joiner(least), f"a {_NODE}, b {_NODE}, similarity double"), "joined")


def _cut_up(rows: DataFrame, least: float, bands: int, keep) -> DataFrame:
    """Buckets of any size as small ones: parts of about half ``LIMIT`` texts of like length, each two of which are a bucket.

    Lengths that ``least`` lets pair are of one class or of neighbouring ones, and only these meet. A pair is left to a small
    bucket that it shares, or else to the first large one (``hot``: bands and values; they follow the small ones' ``bands``), and
    pairs within a part to the bucket of this part alone.
    """
    width = 1.001 * max(float(np.log(1 / least)), 0.01)
    rows = keep(rows.withColumn("level", F.floor(F.log(F.col("n").cast("double")) / width).cast("int")), "levels")
    counts = keep(rows.groupBy("band", "value", "level").agg(F.ceil(2 * F.count("*") / LIMIT).cast("int").alias("parts")), "parts")
    for name, step in (("own", 0), ("above", 1), ("below", -1)):
        there = counts.select("band", "value", (F.col("level") - step).alias("level"), F.col("parts").alias(name))
        rows = rows.join(there, ["band", "value", "level"], "left")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), "own").cast("int"))

    def of(low, low_part, high, high_part):
        return F.struct(low.alias("low"), low_part.alias("low_part"), high.alias("high"), high_part.alias("high_part"))

    level, part = F.col("level"), F.col("part")
    each = lambda name: F.when(F.col(name) > 0, F.sequence(F.lit(0), F.col(name) - 1)).otherwise(F.array().cast("array<int>"))
    pairs = F.concat(
        F.transform(each("own"), lambda o: of(level, F.least(part, o), level, F.greatest(part, o))),
        F.transform(each("above"), lambda o: of(level, part, level + 1, o)),
        F.transform(each("below"), lambda o: of(level - 1, o, level, part)),
    )
    rows = rows.withColumn("pair", F.explode(pairs))
    apart = (F.col("pair.low") != F.col("pair.high")) | (F.col("pair.low_part") != F.col("pair.high_part"))
    place = lambda band, value: F.struct((band + bands).cast("int").alias("band"), value.alias("value"))
    earlier = F.transform(F.filter("hot", lambda x: x["band"] < F.col("band")), lambda x: place(x["band"], x["value"]))
    places = F.concat("places", earlier, F.array(place(F.col("band"), F.xxhash64("level", "part")))).alias("places")
    value = F.xxhash64("band", "value", "pair.low", "pair.low_part", "pair.high", "pair.high_part").alias("value")
    return rows.select((F.col("band") + bands + apart.cast("int")).cast("int").alias("band"), value, "less", "node", "n", "bag", "label_id", "label_h", places)


def classes(docs: DataFrame, *, least: float = SIMILARITY, tiers: int = TIERS) -> DataFrame:
    """Per document row: doc_id, h1 and h2 (hash of the text), class_id, class_h, stays, n_links, linked_id, similarity.

    ``class_id`` is the smallest doc_id of the class; ``stays`` marks the rows with that id and its text. ``n_links``
    counts the verified links of the row's text to other texts; ``linked_id`` is the doc_id of the most similar of these
    and ``similarity`` that link's. Copies of a text without links have the text's smallest id and 1.
    """

    spark, made = docs.sparkSession, []

    def keep(df: DataFrame, name: str) -> DataFrame:
        out, path = stored(df, name)
        made.append(path)
        return out

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"), F.col("text").cast("string").alias("text"))
    rows = keep(keyed.mapInArrow(_sketcher(0), _SKETCHED), "sketches")
    # one text of each set of exact copies, with its smallest id
    low = F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id"))["doc_id"]
    texts = rows.groupBy("h1", "h2").agg(low.alias("id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bag").alias("bag"), F.first("sketches").alias("sketches"))
    texts = keep(texts.select(F.struct(F.col("id"), F.col("h1").alias("h")).alias("node"), "h1", "h2", "copies", "n", "bag", "sketches"), "texts")
    links, labels = _links(texts.select("node", "n", "bag", "sketches"), keyed, None, None, 0, least, tiers, keep)
    # the name of a class is its smallest node
    names = keep(labels.groupBy("label").agg(F.min("node").alias("low")).select("label", F.least("label", "low").alias("name")), "names")
    labels = labels.join(names, "label").select("node", F.col("name").alias("label")).union(names.select(F.col("label").alias("node"), F.col("name").alias("label")))

    ends = links.select("a", "b", "similarity").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    best = ends.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n_links"), F.min(F.struct((-F.col("similarity")).alias("less"), "b")).alias("best"))
    best = keep(best.select("node", "n_links", F.col("best.b.id").alias("linked_id"), (-F.col("best.less")).alias("similarity")), "best")
    joined = texts.select("h1", "h2", "node", "copies").join(labels, "node", "left").join(best, "node", "left")
    own = F.col("copies") > 1
    classed = joined.select(
        "h1", "h2", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNotNull(), F.col("linked_id")).when(own, F.col("node.id")).alias("linked_id"), F.coalesce("similarity", F.when(own, F.lit(1.0))).alias("similarity"),
    )
    classed = keep(classed, "classes")
    for path in made[1:-1]:  # all that is read from here on are the rows and their classes
        drop_path(spark, path)
    out = rows.select("doc_id", "h1", "h2").join(classed, ["h1", "h2"], "left")
    null_text = (F.col("h1") == F.xxhash64(F.lit(None).cast("string"))) & (F.col("h2") == F.xxhash64(F.lit(7), F.lit(None).cast("string")))
    return out.select(
        "doc_id",
        "h1",
        "h2",
        F.when(null_text, F.col("doc_id")).otherwise(F.col("label.id")).alias("class_id"),
        F.when(null_text, F.col("h1")).otherwise(F.col("label.h")).alias("class_h"),
        "n_links",
        F.when(~null_text, F.col("linked_id")).alias("linked_id"),
        F.when(~null_text, F.col("similarity")).alias("similarity"),
    ).withColumn("stays", F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("h1") == F.col("class_h")))


def keep_one(docs: DataFrame, *, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class: that of the smallest id. All columns stay; null texts all stay."""
    found, path = stored(classes(docs, least=least).where("stays").select(F.col("doc_id").alias("__id"), F.col("h1").alias("__h")), "stays")
    staying = found.distinct()
    keyed = docs.withColumn("__h", F.xxhash64("text"))
    out = keyed.join(staying, keyed["doc_id"].cast("long").eqNullSafe(staying["__id"]) & (keyed["__h"] == staying["__h"]), "left_semi")
    if found.count() != staying.count():  # rows that repeat both id and text
        out = out.where(F.col("text").isNull()).union(out.where(F.col("text").isNotNull()).dropDuplicates(["doc_id", "__h"]))
    return out.drop("__h")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "stays", "n_links", "linked_id", F.round("similarity", 6).alias("similarity"))

"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is read as a ring of four 16-bit segments. If two fingerprints
differ in at most 3 bits, then from some segment on every chain of k consecutive
segments differs in at most ``k * 3 / 4`` bits, rounded down: 0, 1, 2, 3. So

* candidates share that first segment exactly, and one half of the next, which may
  differ in one bit only: eight 24-bit keys per fingerprint find them all;
* a candidate pair goes on while the chain stays within budget, and only what is left
  gets the full Hamming check.

Equal fingerprints are merged before anything is compared, so a group of copies costs
one fingerprint. Buckets of a key are compared in blocks of bounded size, each block
pair in a task of its own, and a block pair reports a forest that connects the same
fingerprints as all its links do, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import Batches, chunks, runs, stored, table_batch, texts
from touchtrail.llm.components import components
from touchtrail.llm.rolling import BASES, mixed

SEGMENTS = 4
WIDTH = 16
MAX_BITS = 3
BUDGETS = tuple((k + 1) * MAX_BITS // SEGMENTS for k in range(SEGMENTS))
SEED = 42
BLOCK = 1024
BLOCK_WEIGHT = 1 << 20
MAX_SHINGLES = 1 << 16

Links = Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], np.ndarray]


# -- fingerprints ----------------------------------------------------------------------


def shingle_hashes(words: list[bytes], size: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, space-joined; of all words if fewer."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxh64_intdigest(joined, seed)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    return np.fromiter(
        (
            xxh64_intdigest(joined[a:b], seed)
            for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())
        ),
        np.uint64,
        len(starts),
    )


def bit_majority(hashes: np.ndarray) -> int:
    """Bit by bit, 1 if set in more than half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), MAX_SHINGLES):
        part = hashes[first : first + MAX_SHINGLES]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint) with the 64 bits as a long; no words: 0."""
    schema = pa.schema([pa.field("doc_id", pa.int64()), pa.field("fingerprint", pa.int64())])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for ids, datas in chunks(batches):
            prints = [
                bit_majority(shingle_hashes(data.lower().split(), shingle, SEED)) for data in datas
            ]
            yield table_batch(schema, {"doc_id": ids, "fingerprint": prints})

    return (
        texts(docs, id_col, text_col)
        .select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(run, "doc_id long, fingerprint long")
    )


# -- candidates ------------------------------------------------------------------------


def ring_keys(fingerprint: Column) -> Column:
    """The eight keys of a fingerprint: segment, half of the next one, and which."""
    keys = []
    for i in range(SEGMENTS):
        own = F.shiftrightunsigned(fingerprint, i * WIDTH).bitwiseAND(0xFFFF)
        following = (i + 1) % SEGMENTS * WIDTH
        for half in range(2):
            part = F.shiftrightunsigned(fingerprint, following + 8 * half).bitwiseAND(0xFF)
            keys.append(F.shiftleft(own, 8) + part + F.lit((2 * i + half) << 24))
    return F.array(*keys)


def block_pairs(
    keyed: DataFrame, spread_by: str, block: int = BLOCK, weight: str | None = None
) -> DataFrame:
    """Rows of keys that occur more than once, dealt to pairs of blocks.

    A key with n rows has about ``n / block`` blocks; a row goes to its own block's
    pairs with each of them, so every two rows of a key meet in exactly one place and
    no place gets more than about two blocks of rows. With a ``weight``, blocks of heavy
    rows also stay near ``BLOCK_WEIGHT``. Adds ``lo``, ``hi`` (the pair) and ``own``.
    """
    blocks = F.col("n") / block
    if weight:
        blocks = F.greatest(blocks, F.least("n", F.col("weight") / BLOCK_WEIGHT))
    sizes = (
        keyed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(weight or F.lit(0)).alias("weight"))
        .where("n > 1")
        .select("key", F.ceil(blocks).cast("int").alias("blocks"))
    )
    dealt = keyed.join(sizes, "key").withColumn(
        "own", F.pmod(F.xxhash64(spread_by), F.col("blocks")).cast("int")
    )
    return (
        dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("own", "other"))
        .withColumn("hi", F.greatest("own", "other"))
        .drop("blocks", "other")
    )


def _chain_links(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix of links between two lists of fingerprints.

    Pairs leave as soon as no chain can stay within its budgets; the Hamming distance is
    taken of the remaining pairs only.
    """
    differ = a[:, None] ^ b[None, :]
    segment = [
        np.bitwise_count((differ >> np.uint64(WIDTH * i)) & np.uint64(0xFFFF))
        for i in range(SEGMENTS)
    ]
    hopeful = np.zeros(differ.shape, dtype=bool)
    for i in range(SEGMENTS):
        total = np.zeros(differ.shape, dtype=np.uint8)
        within = np.ones(differ.shape, dtype=bool)
        for k in range(SEGMENTS - 1):
            total = total + segment[(i + k) % SEGMENTS]
            within &= total <= BUDGETS[k]
        hopeful |= within
    linked = np.zeros(differ.shape, dtype=bool)
    rows, columns = np.nonzero(hopeful)
    linked[rows, columns] = np.bitwise_count(differ[rows, columns]) <= MAX_BITS
    return linked


def within_bits(run: dict[str, np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    prints = run["fingerprint"].view(np.uint64)
    return _chain_links(prints[rows], prints[columns])


def forest(run: dict[str, np.ndarray], links: Links) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links of one block pair connect, fewer than its rows."""
    own = run["own"]
    n = len(own)
    diagonal = run["lo"][0] == run["hi"][0]
    reached = np.zeros(n, dtype=bool)
    ends: tuple[list[int], list[int]] = ([], [])

    def neighbours(frontier: np.ndarray, open_: np.ndarray) -> np.ndarray:
        found = np.zeros(len(open_), dtype=bool)
        for first in range(0, len(frontier), 256):
            part = frontier[first : first + 256]
            near = links(run, part, open_)
            if not diagonal:  # rows of one block meet elsewhere
                near &= own[part][:, None] != own[open_][None, :]
            found |= near.any(axis=0)
        return open_[found]

    for root in range(n):
        if reached[root]:
            continue
        reached[root] = True
        frontier = np.array([root])
        while len(frontier) and not reached.all():
            open_ = np.flatnonzero(~reached)
            frontier = neighbours(frontier, open_)
            reached[frontier] = True
            ends[0].extend([root] * len(frontier))
            ends[1].extend(frontier.tolist())
    return np.array(ends[0], dtype=np.int64), np.array(ends[1], dtype=np.int64)


def forest_edges(dealt: DataFrame, node: str, links: Links) -> DataFrame:
    """(a, b) over all block pairs; nodes are longs."""
    schema = pa.schema([pa.field("a", pa.int64()), pa.field("b", pa.int64())])
    keys = ["key", "lo", "hi"]

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        held = 0
        for rows in runs(batches, keys):
            left, right = forest(rows, links)
            if len(left):
                a.append(rows[node][left])
                b.append(rows[node][right])
                held += len(left)
            if held > 50_000:
                yield table_batch(schema, {"a": np.concatenate(a), "b": np.concatenate(b)})
                a, b, held = [], [], 0
        if held:
            yield table_batch(schema, {"a": np.concatenate(a), "b": np.concatenate(b)})

    return (
        dealt.repartition(*(F.col(k) for k in keys))
        .sortWithinPartitions(*keys)
        .mapInArrow(run, "a long, b long")
    )


# -- operator --------------------------------------------------------------------------


def linked_prints(distinct: DataFrame) -> DataFrame:
    """(node, component) of the distinct fingerprints that are within 3 bits of another one."""
    keyed = distinct.select("fingerprint", F.explode(ring_keys(F.col("fingerprint"))).alias("key"))
    dealt = block_pairs(keyed, "fingerprint")
    return components(forest_edges(dealt, "fingerprint", within_bits))  # stored edges underneath


def near_duplicates(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Documents link when their fingerprints differ in at most 3 bits; a component is
    named by its smallest doc_id. Empty and NULL texts have fingerprint 0 and link like
    any other. Repeated rows stay; a row without an id takes part and gets its
    component's id, NULL if no row of it has one. An empty table gives no rows.
    """
    printed = stored(fingerprints(docs, shingle, id_col, text_col), "simhash")
    distinct = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    linked = linked_prints(distinct)
    named = (
        distinct.join(linked, distinct["fingerprint"] == linked["node"], "left")
        .select("fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("root"))
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Stored, so that the join with the documents can split a fingerprint of many copies.
    labels = stored(
        named.join(smallest, "root").select("fingerprint", "component_id"), "simhash-labels"
    )
    return printed.join(labels, "fingerprint").select("doc_id", "fingerprint", "component_id")


# -- groups of similar documents ---------------------------------------------------------

# A pair of similarity s shares a band unless all BANDS differ: (1 - s ** ROWS) ** BANDS,
# 1.3e-7 at 0.8, however the two texts came to differ.
BANDS = 40
ROWS = 5
BAND_BYTES = 8  # so that unequal bands do not meet, at any number of documents
BINS = 256
MULTIPLIERS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * BASES[1]) | np.uint64(1)


def shingle_bands(hashes: np.ndarray) -> bytes:
    """64 bits per band: of the smallest hashes of the shingle set in ROWS orders."""
    smallest = np.full(BANDS * ROWS, ~np.uint64(0), dtype=np.uint64)
    for first in range(0, len(hashes), 1024):
        part = hashes[first : first + 1024, None] * MULTIPLIERS[None, :]
        np.minimum(smallest, part.min(axis=0), out=smallest)
    band = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in smallest.reshape(BANDS, ROWS).T:
        band = mixed(band ^ column) * BASES[0]
    return mixed(band).astype("<u8").tobytes()


def shingle_sketch(hashes: np.ndarray) -> bytes:
    """One byte per bin, of the smallest hash in it; 0 for an empty bin."""
    smallest = np.full(BINS, ~np.uint64(0), dtype=np.uint64)
    np.minimum.at(smallest, (hashes % np.uint64(BINS)).astype(np.int64), hashes)
    value = (mixed(smallest) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    value[smallest == ~np.uint64(0)] = 0
    return value.tobytes()


def _similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of common shingles, row by row; 1 for two texts without words."""
    either = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a > 0) & (a == b)).sum(axis=1)
    share = np.where(either > 0, equal / np.maximum(either, 1), 1.0)
    return np.maximum(0.0, (share - 1 / 255) / (1 - 1 / 255))


def band_keys(bands: Column) -> Column:
    """A key for each band, told apart by its number too."""
    return F.array(
        *(
            F.xxhash64(F.lit(i), F.substring(bands, BAND_BYTES * i + 1, BAND_BYTES))
            for i in range(BANDS)
        )
    )


def first_meetings(run: dict[str, np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Matrix of the pairs that share no earlier band: each pair is looked at once."""
    if "_before" not in run:
        run["_before"] = np.frombuffer(b"".join(run["before"]), "<u8").reshape(len(run["own"]), -1)
    a, b = run["_before"][rows], run["_before"][columns]
    result = np.ones((len(rows), len(columns)), dtype=bool)
    for i in range(a.shape[1]):
        result &= a[:, i, None] != b[None, :, i]
    return result


def _verdicts(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sketches that are surely similar, and those only the sets can tell.

    The bounds stand so many standard errors from ``least`` that a wrong verdict has a
    chance of about 2e-7 on either side.
    """
    either = ((a > 0) | (b > 0)).sum(axis=1)
    error = np.sqrt(least * (1 - least) / np.maximum(either, 1))
    share = _similarity(a, b)
    sure = share >= least + 5 * error
    return sure, ~sure & (share >= least - 6 * error)


def sketch_verdicts(
    run: dict[str, np.ndarray], rows: np.ndarray, columns: np.ndarray, asked: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_verdicts` as two matrices; False where ``asked`` is."""
    if "_bins" not in run:
        run["_bins"] = np.frombuffer(b"".join(run["sketch"]), np.uint8).reshape(-1, BINS)
    bins = run["_bins"]
    sure, doubtful = np.zeros_like(asked), np.zeros_like(asked)
    i, j = np.nonzero(asked)
    for first in range(0, len(i), 1 << 14):
        a, b = i[first : first + (1 << 14)], j[first : first + (1 << 14)]
        sure[a, b], doubtful[a, b] = _verdicts(bins[rows[a]], bins[columns[b]], least)
    return sure, doubtful


def sketch_links(least: float) -> Links:
    """Links of documents that share a band and whose shingle sketches leave no doubt."""

    def links(run: dict[str, np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        return sketch_verdicts(run, rows, columns, first_meetings(run, rows, columns), least)[0]

    return links


def _apart(run: dict[str, np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Matrix of the pairs that are compared here and that no sure links connect."""
    apart = first_meetings(run, rows, columns)
    apart &= run["label"][rows][:, None] != run["label"][columns][None, :]
    if run["lo"][0] != run["hi"][0]:
        apart &= run["own"][rows][:, None] != run["own"][columns][None, :]
    return apart


def in_doubt(run: dict[str, np.ndarray], least: float) -> np.ndarray:
    """Rows of a block pair with a partner that only the sets can tell."""
    n = len(run["own"])
    every, found = np.arange(n), np.zeros(n, dtype=bool)
    for first in range(0, n, 256):
        part = every[first : first + 256]
        later = every[first:]
        doubtful = sketch_verdicts(run, part, later, _apart(run, part, later), least)[1]
        found[part] |= doubtful.any(axis=1)
        found[later] |= doubtful.any(axis=0)
    return np.flatnonzero(found)


def shares(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of one set of hashes with others; all are sorted and distinct."""
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    values = np.concatenate(others)
    hits = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
    ends = np.cumsum(sizes)
    common = np.diff(np.concatenate(([0], np.cumsum(hits)))[np.concatenate(([0], ends))])
    return common / (len(own) + sizes - common)


def exact_links(least: float) -> Links:
    """Links of doubtful pairs by their shingle sets; what is connected anyway is linked."""

    def links(run: dict[str, np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        if "_sets" not in run:
            run["_sets"] = [np.frombuffer(s, "<u8") for s in run["shingles"]]
        sets = run["_sets"]
        asked = sketch_verdicts(run, rows, columns, _apart(run, rows, columns), least)[1]
        near = run["label"][rows][:, None] == run["label"][columns][None, :]
        reached = np.zeros(len(columns), dtype=bool)
        for i in range(len(rows)):  # one link per column is enough
            at = np.flatnonzero(asked[i] & ~reached)
            for first in range(0, len(at), 64):
                some = at[first : first + 64]
                near[i, some] = shares(sets[rows[i]], [sets[k] for k in columns[some]]) >= least
            reached[at] |= near[i, at]
        return near

    return links


DOUBTS = "key long, lo int, hi int, own int, label int, node long, before binary, sketch binary"


def sketched_edges(dealt: DataFrame, least: float) -> DataFrame:
    """Edges (a, b) of sure links, and with NULLs there the rows that are in doubt."""
    names = [c.split()[0] for c in DOUBTS.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), *zip(names, types)])
    keys = ["key", "lo", "hi"]

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        n_held = 0

        def batch() -> pa.RecordBatch:
            columns = {n: [x for h in held for x in h[n]] for n in schema.names}
            return table_batch(schema, columns)

        for rows in runs(batches, keys):
            left, right = forest(rows, sketch_links(least))
            rows["label"] = np.arange(len(rows["own"]), dtype=np.int32)
            rows["label"][right] = left
            doubtful = in_doubt(rows, least)
            none, blank = [None] * len(left), [None] * len(doubtful)
            if len(left) or len(doubtful):
                held.append(
                    {"a": [*rows["node"][left].tolist(), *blank], "b": [*rows["node"][right].tolist(), *blank]}
                    | {n: [*none, *rows[n][doubtful].tolist()] for n in names}
                )
                n_held += len(left) + len(doubtful)
            if n_held > 10_000:
                yield batch()
                held, n_held = [], 0
        if held:
            yield batch()

    return (
        dealt.repartition(*(F.col(k) for k in keys))
        .sortWithinPartitions(*keys)
        .mapInArrow(run, f"a long, b long, {DOUBTS}")
    )


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles): sorted distinct hashes of (doc_id, text) rows."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for ids, datas in chunks(batches):
            sets = [
                np.unique(shingle_hashes(data.lower().split(), shingle, SEED)).tobytes() for data in datas
            ]
            yield table_batch(schema, {"node": ids, "shingles": sets})

    return docs.mapInArrow(run, "node long, shingles binary")


def print_clusters(firsts: DataFrame) -> DataFrame:
    """(fingerprint, cluster) of the fingerprints that several rows have or come within 3 bits of."""
    distinct = stored(firsts.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows")), "similar-fingerprints")
    linked = linked_prints(distinct.select("fingerprint"))
    # Stored, so that the join with the texts can split a fingerprint of many texts.
    return stored(
        distinct.join(linked, F.col("fingerprint") == F.col("node"), "left")
        .where("rows > 1 OR component IS NOT NULL")
        .select("fingerprint", F.coalesce("component", "fingerprint").alias("cluster")),
        "similar-clusters",
    )


def similar_groups(
    docs: DataFrame,
    shingle: int = 5,
    least: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, group_id) of every document that is similar to another one.

    Ids must be unique and not NULL. Candidates are texts whose SimHash fingerprints are
    connected within 3 bits, as pigeonring finds them, and, as fingerprints of similar texts
    can be further apart, texts that share one of ``BANDS`` bands of smallest shingle hashes.
    Candidates are linked when the share of common ``shingle``-word shingles is at least
    ``least``; equal word sequences always are. A sketch tells the share where it is far from
    ``least``, the sets themselves elsewhere. A group is named by its smallest id. Case is ignored.
    """
    schema = pa.schema(
        [
            pa.field("doc_id", pa.int64()),
            pa.field("same", pa.binary()),
            pa.field("size", pa.int64()),
            pa.field("fingerprint", pa.int64()),
            pa.field("bands", pa.binary()),
            pa.field("sketch", pa.binary()),
        ]
    )

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for ids, datas in chunks(batches):
            rows: dict[str, list] = {"same": [], "size": [], "fingerprint": [], "bands": [], "sketch": []}
            for data in datas:
                words = data.lower().split()
                rows["same"].append(sha256(b" ".join(words)).digest())
                hashes = shingle_hashes(words, shingle, SEED)
                rows["size"].append(len(hashes))
                rows["fingerprint"].append(bit_majority(hashes))
                rows["bands"].append(shingle_bands(hashes))
                rows["sketch"].append(shingle_sketch(hashes))
            yield table_batch(schema, {"doc_id": ids} | rows)

    read = texts(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    printed = stored(
        read.mapInArrow(
            run, "doc_id long, same binary, size long, fingerprint long, bands binary, sketch binary"
        ),
        "similar-prints",
    )
    # Stored, so that the join with all rows can split a sequence of many copies.
    same = stored(printed.groupBy("same").agg(F.min("doc_id").alias("node")), "similar-same")
    firsts = stored(
        printed.join(same.select("node"), F.col("doc_id") == F.col("node")).select(
            "node", "size", "fingerprint", "bands", "sketch"
        ),
        "similar-firsts",
    )
    clusters = print_clusters(firsts)
    keyed = firsts.select("node", "size", F.posexplode(band_keys(F.col("bands"))).alias("band", "key")).unionByName(
        firsts.join(clusters, "fingerprint").select(
            "node", "size", F.lit(BANDS).alias("band"), F.xxhash64(F.lit(BANDS), "cluster").alias("key")
        )
    )
    # The earlier bands of a row tell which pairs have met already, all bands those of a cluster.
    dealt = (
        block_pairs(keyed, "node", weight="size")
        .drop("size")
        .join(firsts.drop("size", "fingerprint"), "node")
        .withColumn("before", F.substring("bands", F.lit(1), F.col("band") * BAND_BYTES))
        .drop("bands", "band")
    )
    told = stored(sketched_edges(dealt, least), "similar-told")
    doubts = told.where("node IS NOT NULL").drop("a", "b")
    wanted = doubts.select("node").distinct()
    sets = shingle_sets(read.join(wanted, F.col("doc_id") == F.col("node"), "left_semi"), shingle)
    edges = (
        told.where("a IS NOT NULL").select("a", "b")
        .unionByName(forest_edges(doubts.join(sets, "node"), "node", exact_links(least)))
    )
    linked = components(edges)
    grouped = printed.select("doc_id", "same").join(same, "same")
    return (
        grouped.join(linked, "node", "left")
        .select("doc_id", F.coalesce("component", "node").alias("group_id"))
    )

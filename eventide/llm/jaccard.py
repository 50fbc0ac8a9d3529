"""N-gram Jaccard join with set-relation skipping (operator 3).

Exact: documents link when 100 * |A and B| >= 75 * |A or B| of their shingle
sets. The work is done on distinct sets; equal sets share their answers.

1. One pass counts shingles in a count sketch of fixed size. It gives a global
   order, rarest first; any order is correct, this one keeps index lists short.
2. Each set's prefix (enough of its rarest shingles that two linked sets must
   share one) is indexed: lists by shingle, each entry with its set's size and
   the shingle's position.
3. Within a list and a band of sizes the sets are compared with a few leaders
   only. A set linked to a leader takes over the leader's component, so a family
   of thousands of near copies costs a few comparisons a set, not all pairs.
4. What is left are pairs of sets of different components that share a list.
   Lists are read in blocks by size; size and position skip most of them.
Before full sets are compared, bit maps of the sets (a bit or two a shingle, an
exact bound on the overlap) drop the pairs that cannot link.

5. All links are inside components. There each set is held as its differences from
   the component's leader, whose overlaps with all sets are then known; any other
   pair's overlap is derived from those by the shingles in which the two differ.
   Blocks of sets whose sizes are too far apart never meet. Links are counted, not
   emitted as pairs.

Sets are named by 64-bit digests of 64-bit shingle hashes.

Defined results: null or empty text (and text without words) has size 0, links
with nothing and is its own component; repeated rows link like any equal texts;
null ids count for no component's smallest id (null if it has no other); an empty
table gives no rows; other columns are not read. A text is held in memory some
60 times over while it is cut into words, however long it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .components import connected_components
from .runtime import discard, scope, stored, texts_of
from .words import LOWER, SPACE_WORDS, mix, shingle_hashes, span_hashes, text_chunks, word_spans

#: Buckets of the count sketch (2 ** 18 counts of 8 bytes are 2 MB, whatever the corpus).
SKETCH_BITS = 18
#: Bits of the map that tells which sets stand in any pair to be compared (512 kB).
MARK_BITS = 22
LEADERS = 6
ROUNDS = 1
BLOCK = 1024
SHARE = (3, 4)  # 0.75


def _sets(col: pa.Array, k: int):
    """(first row, distinct shingle hashes of all rows, ascending in each row, row
    offsets, names of the sets) of runs of texts. Empty sets are named 0."""
    for lo, hi, data, off in text_chunks(col):
        start, end, first = word_spans(data, off, SPACE_WORDS)
        flat, at = shingle_hashes(span_hashes(LOWER[data], start, end), first, k)
        for i in range(hi - lo):
            flat[at[i]:at[i + 1]].sort()
        fresh = np.ones(len(flat), dtype=bool)
        fresh[1:] = flat[1:] != flat[:-1]
        fresh[at[:-1][at[:-1] < len(flat)]] = True
        at = np.concatenate(([0], np.cumsum(fresh)))[at]
        flat = flat[fresh]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)))
        size = np.diff(at).astype(np.uint64)
        name = mix(total[at[1:]] - total[at[:-1]] + size).view(np.int64)
        yield lo, flat, at, np.where(size > 0, name, 0)


def _firsts(name: np.ndarray) -> list[int]:
    """Rows with a set that no earlier row of the run has."""
    _, at = np.unique(name, return_index=True)
    return np.sort(at[name[at] != 0]).tolist()


def _survey(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """Rows (doc_id, n, cls, bits) of all documents (the bit map once a run of
    texts for each set), and rows (part, counts) of the sketch: one set a task."""
    part = 1 << min(14, bits)
    columns = ["doc_id", "n", "cls", "bits", "part", "counts"]
    id_type = docs.schema["doc_id"].dataType
    id_arrow = to_arrow_type(id_type)

    def run(batches):
        counts = np.zeros(1 << bits, dtype=np.uint32)
        nothing = pa.nulls
        for b in batches:
            for lo, flat, at, name in _sets(b.column(1), k):
                counts += np.bincount((flat >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint32)
                m = len(name)
                maps: list[bytes | None] = [None] * m
                for i in _firsts(name):
                    maps[i] = set_bits(flat[at[i]:at[i + 1]])
                yield pa.record_batch(
                    [b.column(0).slice(lo, m), pa.array(np.diff(at).astype(np.int32)), pa.array(name, mask=name == 0),
                     pa.array(maps, pa.binary()), nothing(m, pa.int32()), nothing(m, pa.binary())], columns)
        if counts.any():
            cut = counts.reshape(-1, part)
            m = len(cut)
            yield pa.record_batch([nothing(m, id_arrow), nothing(m, pa.int32()), nothing(m, pa.int64()), nothing(m, pa.binary()),
                                   pa.array(np.arange(m, dtype=np.int32)), pa.array([c.tobytes() for c in cut], pa.binary())], columns)

    return docs.mapInArrow(run, f"doc_id {id_type.simpleString()}, n int, cls long, bits binary, part int, counts binary")


def _sketch(survey: DataFrame, bits: int) -> np.ndarray:
    """The summed sketch; every task adds up its parts as they stream by."""
    part = 1 << min(14, bits)

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[p] = total.get(p, 0) + np.frombuffer(c, np.uint32).astype(np.uint64)
        if total:
            yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                  ["part", "counts"])

    out = np.zeros(1 << bits, dtype=np.uint64)
    for p, c in (survey.where("part is not null").select("part", "counts").repartition(8, "part")
                 .mapInArrow(add, "part int, counts binary").collect()):  # 8 bytes a bucket
        out[p * part:(p + 1) * part] = np.frombuffer(c, np.uint64)
    return out


def prefix_size(n: int) -> int:
    """So many of a set's first shingles hold one that any linked set shares."""
    return n - -(-SHARE[0] * n // SHARE[1]) + 1


def _index(docs: DataFrame, k: int, sketch, bits: int) -> DataFrame:
    """token, cls, n, pos of the prefixes; equal sets once a run of texts."""
    def run(batches):
        counts = np.minimum(sketch.value, np.uint64((1 << 20) - 1)) << np.uint64(44)
        for b in batches:
            for _, flat, at, name in _sets(b.column(1), k):
                # rarest bucket first, then by hash: rows are ascending, so a stable sort settles ties alike everywhere
                order = counts[(flat >> np.uint64(64 - bits)).astype(np.int64)] | (flat >> np.uint64(20))
                rows = _firsts(name)
                if not rows:
                    continue
                n = np.diff(at)[rows]
                size = np.array([prefix_size(int(x)) for x in n])
                token = np.concatenate([flat[at[i]:at[i + 1]][np.argsort(order[at[i]:at[i + 1]], kind="stable")[:p]]
                                        for i, p in zip(rows, size)])
                yield pa.record_batch(
                    [pa.array(token.view(np.int64)), pa.array(np.repeat(name[rows], size)),
                     pa.array(np.repeat(n.astype(np.int32), size)),
                     pa.array(np.concatenate([np.arange(p, dtype=np.int32) for p in size]))],
                    ["token", "cls", "n", "pos"])

    return docs.mapInArrow(run, "token long, cls long, n int, pos int")


def _marks(pairs: DataFrame) -> np.ndarray:
    """Bit map of the sets in pairs, by the low bits of the digest."""
    words = np.zeros(1 << (MARK_BITS - 6), dtype=np.int64)
    at = (pairs.select(F.explode(F.array("a", "b")).alias("cls"))
          .select(F.pmod("cls", F.lit(1 << MARK_BITS)).alias("at")))
    got = (at.groupBy(F.expr("cast(at div 64 as int)").alias("w"))
           .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("b")).collect())
    for w, b in got:  # at most 2 ** (MARK_BITS - 6) rows of two numbers
        words[w] = b
    return words.view(np.uint64)


def set_bits(s: np.ndarray) -> bytes:
    """The parity of the shingles that fall on each of w bits, w the power of two
    from the set's size on (256 at least). Half the map is the xor of its halves."""
    width = max(256, 1 << (len(s) - 1).bit_length())
    n = np.bincount((mix(s) & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((n & 1).astype(np.uint8)).tobytes()


def bits_differ(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two maps differ, the longer one folded to the shorter: at
    most the number of shingles that only one of the sets has."""
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def may_link(n_a: int, n_b: int, differ: int) -> bool:
    """Whether the bound on the overlap allows a link."""
    return linked(n_a, n_b, (n_a + n_b - differ) // 2)


def _full_sets(docs: DataFrame, k: int, marks) -> DataFrame:
    """cls, shingles (sorted, 8 bytes each) of the marked sets."""
    def run(batches):
        known = marks.value
        for b in batches:
            for _, flat, at, name in _sets(b.column(1), k):
                low = name % (1 << MARK_BITS)
                marked = known[low >> 6] >> (low & 63).astype(np.uint64) & np.uint64(1)
                rows = [i for i in _firsts(name) if marked[i]]
                if rows:
                    yield pa.record_batch([pa.array(name[rows]),
                                           pa.array([flat[at[i]:at[i + 1]].tobytes() for i in rows], pa.binary())], ["cls", "shingles"])

    return docs.mapInArrow(run, "cls long, shingles binary").dropDuplicates(["cls"])


def linked(n_a, n_b, both):
    """Whether 100 * both >= 75 * (n_a + n_b - both), in whole numbers."""
    return SHARE[1] * both >= SHARE[0] * (n_a + n_b - both)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set names that link, by their full sets."""
    one = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for b in batches:
            a, c = b.column(2).to_pylist(), b.column(3).to_pylist()
            ok = []
            for x, y in zip(a, c):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                ok.append(linked(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
            yield pa.record_batch([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) whose sizes and bit maps allow a link."""
    rest = [c for c in pairs.columns if c not in ("a", "b")]

    def run(batches):
        for b in batches:
            na, nb, xs, ys = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("na", "nb", "xa", "xb"))
            ok = [may_link(i, j, bits_differ(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)))
                  for i, j, x, y in zip(na, nb, xs, ys)]
            yield b.select(["a", "b", *rest]).filter(pa.array(ok, pa.bool_()))

    sides = [classes.select(F.col("cls").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"x{s}")) for s in "ab"]
    both = (pairs.join(sides[0], "a").join(sides[1], "b").where((SHARE[0] * F.col("na") <= SHARE[1] * F.col("nb"))
                                                                & (SHARE[0] * F.col("nb") <= SHARE[1] * F.col("na"))))
    return both.select("a", "b", *rest, "na", "nb", "xa", "xb").mapInArrow(
        run, "a long, b long" + "".join(f", {c} {pairs.schema[c].dataType.simpleString()}" for c in rest))


def _leaders(what, *salt) -> Column:
    """The sets (or what is asked of them) of smallest hash in the list and size
    band of a row."""
    band = Window.partitionBy("token", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(SHARE[1] / SHARE[0]))))
    return F.array(*(F.min_by(what, F.xxhash64("cls", F.lit(j), *salt)).over(band) for j in range(LEADERS)))


def _star_pairs(lists: DataFrame) -> DataFrame:
    """a, b, turn: each set of a list with the leaders of its size band, who are
    the same in most lists of a family; turn is the first leader's number."""
    each = (lists.select("cls", _leaders("cls").alias("leaders"))
            .select("cls", F.posexplode("leaders").alias("turn", "lead")).where("cls <> lead"))
    return (each.groupBy(F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b"))
            .agg(F.min("turn").alias("turn")))


def _apart(lists: DataFrame, roots: DataFrame, salt: int) -> DataFrame:
    """Pairs of sets of different components: each set with leaders that change
    from list to list."""
    named = _named(lists, roots)
    each = (named.select("cls", "root", F.array_distinct(_leaders(F.struct("cls", "root"), "token", F.lit(salt))).alias("leaders"))
            .select("cls", "root", F.explode("leaders").alias("lead")).where("root <> lead.root"))
    return each.select(F.least("cls", "lead.cls").alias("a"), F.greatest("cls", "lead.cls").alias("b")).distinct()


def _named(lists: DataFrame, roots: DataFrame) -> DataFrame:
    return (lists.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
            .withColumn("root", F.coalesce("root", "cls")))


def _cross_pairs(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of sets of different components that share a list and pass the
    bounds on size and position."""
    named = _named(lists, roots)
    whole = Window.partitionBy("token")
    mixed = (named.withColumn("lo", F.min("root").over(whole)).withColumn("hi", F.max("root").over(whole)).where("lo < hi")
             .withColumn("block", F.floor((F.row_number().over(whole.orderBy("n", "cls")) - 1) / BLOCK).cast("int"))
             .withColumn("last", F.max("block").over(whole)))
    rows = (mixed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
            .select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "cls", "root", "n", "pos"))

    def run(batches):
        held = []
        for b in batches:
            held.append(b)
            t = pa.Table.from_batches(held)
            key = np.stack([np.asarray(t.column(c)) for c in ("token", "i", "j")])
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(new):
                yield from _pairs_of(t.slice(0, new[-1]), [0, *new.tolist()])
                held = t.slice(new[-1]).to_batches()
        if held:
            t = pa.Table.from_batches(held)
            key = np.stack([np.asarray(t.column(c)) for c in ("token", "i", "j")])
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            yield from _pairs_of(t, [0, *new.tolist(), t.num_rows])

    return (rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "cls")
            .mapInArrow(run, "a long, b long").distinct())


def _pairs_of(t: pa.Table, cuts: list[int]):
    """Candidate pairs of each group (one block of a list, or two) of sorted rows."""
    i, j, block, cls, root, n, pos = (np.asarray(t.column(c)).astype(np.int64) for c in ("i", "j", "block", "cls", "root", "n", "pos"))
    found_a, found_b = [], []
    for lo, hi in zip(cuts, cuts[1:]):
        at = np.arange(lo, hi)
        one = at if i[lo] == j[lo] else at[block[lo:hi] == i[lo]]
        two = at if i[lo] == j[lo] else at[block[lo:hi] == j[lo]]
        # both are sorted by size: for each set of one, the run of two that is not too large
        if not len(one) or not len(two) or SHARE[0] * n[two[0]] > SHARE[1] * n[one[-1]]:
            continue
        for x0 in range(0, len(one), 256):
            a = one[x0:x0 + 256, None]
            ok = (root[a] != root[two]) & (SHARE[0] * n[two] <= SHARE[1] * n[a]) & (SHARE[0] * n[a] <= SHARE[1] * n[two])
            if i[lo] == j[lo]:
                ok &= a < two
            need = -(-SHARE[0] * (n[a] + n[two]) // (SHARE[0] + SHARE[1]))
            ok &= np.minimum(n[a] - pos[a], n[two] - pos[two]) >= need
            x, y = np.nonzero(ok)
            x, y = cls[one[x0 + x]], cls[two[y]]
            found_a.append(np.minimum(x, y))
            found_b.append(np.maximum(x, y))
    if found_a:
        both = np.unique(np.stack((np.concatenate(found_a), np.concatenate(found_b))), axis=1)
        yield pa.record_batch([pa.array(both[0]), pa.array(both[1])], ["a", "b"])


def _through(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs with ra and rb, the roots of both."""
    name = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    for s in "ab":
        pairs = (pairs.join(name, F.col(s) == F.col("_n"), "left")
                 .withColumn(f"r{s}", F.coalesce("_r", s)).drop("_n", "_r"))
    return pairs


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """node, root of the components after further links (a, b)."""
    upper = connected_components(_through(links, roots).select(F.col("ra").alias("u"), F.col("rb").alias("v")))
    top = upper.select(F.col("node").alias("_m"), F.col("root").alias("_t"))
    lower = (roots.join(top, F.col("root") == F.col("_m"), "left")
             .select("node", F.coalesce("_t", "root").alias("root")))
    return stored(lower.union(upper), "roots")


# --- links within the components ---------------------------------------------

def _band(n: Column) -> Column:
    """Size bands so wide that linked sets are in the same or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(SHARE[1] / SHARE[0])) + 1e-9).cast("int")


def _against_leader(members: DataFrame) -> DataFrame:
    """cls, root, n, copies, lead_n, minus, plus: each set as the leader's shingles
    that it lacks and its own that the leader lacks (the leader is the set that names
    the component)."""
    leaders = members.where("cls = root").select(F.col("root").alias("_r"), F.col("shingles").alias("lead"))
    both = members.join(leaders, F.col("root") == F.col("_r")).select("cls", "root", "copies", "shingles", "lead")

    def run(batches):
        for b in batches:
            n, lead_n, minus, plus = [], [], [], []
            for s, lead in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                s, lead = np.frombuffer(s, np.uint64), np.frombuffer(lead, np.uint64)
                n.append(len(s))
                lead_n.append(len(lead))
                minus.append(np.setdiff1d(lead, s, assume_unique=True).tobytes())
                plus.append(np.setdiff1d(s, lead, assume_unique=True).tobytes())
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int32()), pa.array(lead_n, pa.int32()),
                                   pa.array(minus, pa.binary()), pa.array(plus, pa.binary())],
                                  ["cls", "root", "copies", "n", "lead_n", "minus", "plus"])

    return both.mapInArrow(run, "cls long, root long, copies long, n int, lead_n int, minus binary, plus binary")


def _common(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """How many shingles each of one shares with each of two (sorted lists of them)."""
    sides = []
    for side in (one, two):
        own = [np.frombuffer(x, np.uint64) for x in side]
        token = np.concatenate(own) if own else np.zeros(0, np.uint64)
        row = np.repeat(np.arange(len(own)), [len(x) for x in own])
        order = np.argsort(token, kind="stable")
        sides.append((token[order], row[order]))
    (ta, ra), (tb, rb) = sides
    out = np.zeros((len(one), len(two)), np.int32)
    shared = np.intersect1d(ta, tb)
    a0, a1 = np.searchsorted(ta, shared), np.searchsorted(ta, shared, "right")
    b0, b1 = np.searchsorted(tb, shared), np.searchsorted(tb, shared, "right")
    many = (a1 - a0) * (b1 - b0)
    for i in np.flatnonzero(many > 4096).tolist():  # a shingle of many sets: a block at once
        out[np.ix_(ra[a0[i]:a1[i]], rb[b0[i]:b1[i]])] += 1
    few = np.flatnonzero(many <= 4096)
    cuts = np.searchsorted(np.cumsum(many[few]), np.arange(1 << 20, int(many[few].sum()) + (1 << 20), 1 << 20))
    for part in np.split(few, np.unique(cuts[cuts < len(few)])):
        size = many[part]
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        wide = np.repeat(b1[part] - b0[part], size)
        i, j = ra[np.repeat(a0[part], size) + place // np.maximum(wide, 1)], rb[np.repeat(b0[part], size) + place % np.maximum(wide, 1)]
        out += np.bincount(i * len(two) + j, minlength=out.size).reshape(out.shape).astype(np.int32)
    return out


def _answers(key, rows):
    """Links of the sets of one block with those of another (or among themselves).

    The leader's answers, its overlaps with every set, are known from what each set
    lacks of it; the overlap of any two sets follows from them by the shingles in
    which the two differ from the leader: |L| - |lack S| - |lack T| + |lack both| +
    |more both|."""
    same = key[1].as_py() == key[2].as_py() and key[3].as_py() == key[4].as_py()
    side = rows.column("side").to_numpy()
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
    cls, n, copies = (rows.column(c).to_numpy().astype(np.int64) for c in ("cls", "n", "copies"))
    lead = rows.column("lead_n").to_numpy().astype(np.int64)
    minus, plus = rows.column("minus").to_pylist(), rows.column("plus").to_pylist()
    lack = np.array([len(x) // 8 for x in minus], np.int64)
    pick = lambda values, at: [values[i] for i in at.tolist()]
    both = (lead[one][:, None] - lack[one][:, None] - lack[two][None, :] + _common(pick(minus, one), pick(minus, two))
            + _common(pick(plus, one), pick(plus, two)))
    ok = linked(n[one][:, None], n[two][None, :], both)
    if same:
        np.fill_diagonal(ok, False)
    out = [(cls[one], ok @ copies[two], ok.sum(axis=1))]
    if not same:
        out.append((cls[two], copies[one] @ ok, ok.sum(axis=0)))
    return pa.table([pa.array(np.concatenate([o[k] for o in out]).astype(np.int64)) for k in range(3)], names=["cls", "docs", "sets"])


def _block_rows(members: DataFrame, block: int) -> DataFrame:
    """A row of each member for every pair of blocks that its own is in: blocks are
    parts of a size band of a component, and a band meets itself and its neighbours
    only, so pairs of blocks that sizes keep apart are never made."""
    m = members.withColumn("band", _band(F.col("n")))
    parts = m.groupBy("root", "band").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("parts"))
    wide = (parts.alias("p").join(parts.select("root", (F.col("band") - 1).alias("band"), F.col("parts").alias("above")), ["root", "band"], "left")
            .join(parts.select("root", (F.col("band") + 1).alias("band"), F.col("parts").alias("below")), ["root", "band"], "left"))
    m = m.join(wide, ["root", "band"]).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    upto = lambda c: F.when(F.col(c) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))

    def place(lo, hi, i, j, s):
        return F.struct(lo.alias("lo"), hi.alias("hi"), i.alias("i"), j.alias("j"), s.cast("int").alias("side"))

    band, part = F.col("band"), F.col("part")
    places = F.concat(
        F.transform(upto("parts"), lambda o: place(band, band, F.least(part, o), F.greatest(part, o), part > o)),
        F.transform(upto("above"), lambda o: place(band, band + 1, part, o, F.lit(0))),
        F.transform(upto("below"), lambda o: place(band - 1, band, o, part, F.lit(1))))
    return m.select("root", F.explode(places).alias("at"), "cls", "n", "copies", "lead_n", "minus", "plus").select(
        "root", "at.*", "cls", "n", "copies", "lead_n", "minus", "plus")


def _links(base: DataFrame, k: int, rows: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """cls, docs, sets: the documents with other sets, and the other sets, that link
    to each set of a component of several sets."""
    sc = base.sparkSession.sparkContext
    inside = stored(roots.select(F.col("node").alias("cls"), "root").union(roots.select(F.col("root").alias("cls"), "root").distinct()), "members")
    sets = _full_sets(base, k, sc.broadcast(_marks(inside.select(F.col("cls").alias("a"), F.col("root").alias("b")))))
    copies = rows.where("cls is not null").groupBy("cls").agg(F.count("*").alias("copies"))
    members = stored(inside.join(sets, "cls").join(copies, "cls").select("cls", "root", "copies", "shingles"), "member-sets")
    differ = stored(_against_leader(members), "differences")
    discard(members)
    return (_block_rows(differ, block).groupBy("root", "lo", "hi", "i", "j")
            .applyInArrow(_answers, "cls long, docs long, sets long")
            .groupBy("cls").agg(F.sum("docs").alias("docs"), F.sum("sets").alias("sets")))


def jaccard_join(docs: DataFrame, k: int = 5, sketch_bits: int = SKETCH_BITS, block: int = BLOCK) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, n_links (the other
    documents that it links to, those with an equal set among them), n_linked_sets
    (the different sets that its set links to) and set_id, equal for equal sets."""
    with scope(docs.sparkSession):
        base = texts_of(docs)
        steps: dict[str, DataFrame] = {}
        found = _components(base, k, sketch_bits, steps)
        links = _links(base, k, steps["rows"], steps["roots"], block)
        copies = steps["rows"].where("cls is not null").groupBy("cls").agg((F.count("*") - 1).alias("others"))
        each = copies.join(links, "cls", "left").select(
            F.col("cls").alias("set_id"), (F.col("others") + F.coalesce("docs", F.lit(0))).alias("n_links"),
            F.coalesce("sets", F.lit(0)).cast("long").alias("n_linked_sets"))
        out = found.join(each, "set_id", "left").select(
            "doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("n_linked_sets", F.lit(0)).cast("long").alias("n_linked_sets"), "set_id")
        return stored(out, "join", outlives=True)


def jaccard_components(docs: DataFrame, k: int = 5, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One row a document: doc_id (of any type with an order), n_shingles,
    component_id (smallest doc_id that links reach). The tables of the steps are
    removed once the result is stored."""
    with scope(docs.sparkSession):
        return stored(_components(texts_of(docs), k, sketch_bits, {}).drop("set_id"), "components", outlives=True)


def _components(base: DataFrame, k: int, sketch_bits: int, steps: dict[str, DataFrame]) -> DataFrame:
    """doc_id, n_shingles, component_id, set_id; ``steps`` gets the tables that links need."""
    sc = base.sparkSession.sparkContext
    survey = stored(_survey(base, k, sketch_bits), "survey")
    rows = survey.where("part is null").select("doc_id", "n", "cls")
    classes = survey.where("bits is not null").groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    sketch = sc.broadcast(_sketch(survey, sketch_bits))

    by_token = Window.partitionBy("token")
    index = _index(base, k, sketch, sketch_bits)
    lists = stored(index.withColumn("lo", F.min("cls").over(by_token)).withColumn("hi", F.max("cls").over(by_token))
                   .where("lo < hi").select("token", "cls", "n", "pos").distinct(), "lists")

    # leaders first: two of them, then the others for sets that are still apart
    stars = stored(_possible(_star_pairs(lists), classes), "stars")
    sets = stored(_full_sets(base, k, sc.broadcast(_marks(stars))), "sets")
    first = _verified(stars.where("turn < 2").select("a", "b"), sets)
    roots = stored(connected_components(first.toDF("u", "v")), "roots")
    again = _through(stars.where("turn >= 2"), roots).where("ra <> rb").select("a", "b")
    roots = _merged(roots, stored(_verified(again, sets), "links"))
    for salt in range(ROUNDS):  # a pair whose sets were not gathered is left to the last step
        apart = _possible(_apart(lists, roots, salt), classes)
        roots = _merged(roots, stored(_verified(apart, sets), "links"))

    # then every pair of different components that a list allows
    cross = stored(_possible(_cross_pairs(lists, roots), classes), "cross")
    if not cross.isEmpty():
        more = _full_sets(base, k, sc.broadcast(_marks(cross)))
        roots = _merged(roots, stored(_verified(cross, more), "links"))

    steps |= {"rows": rows, "roots": roots}
    # a set without a link, and the root of a component, are no child of any: they name themselves
    smallest = (rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
                .join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
                .withColumn("root", F.coalesce("root", "cls")))
    component = smallest.groupBy("root").agg(F.min("least").alias("component_id"))
    named = smallest.select("cls", "root").join(component, "root").select("cls", "component_id")
    full = rows.where("cls is not null").join(named, "cls").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id",
                                                                   F.col("cls").alias("set_id"))
    empty = rows.where("cls is null").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                             F.lit(None).cast("long").alias("set_id"))
    return full.unionByName(empty)

"""SimHash near-duplicates by anchor-point covering.

The anchors are the code words of a covering code: the perfect binary Golay code of length 23, in which every word is within
3 bits of exactly one code word. For a threshold of t bits, a fingerprint *owns* the anchor within 3 bits and is a *guest* of every anchor
within 3 + t. Of two fingerprints at most t bits apart, one is a guest of the other's own anchor, so comparing owners with
guests at each anchor finds all such pairs. A table may use several code words at once (a direct sum of
the code): then the excess over 3, summed over the words, is at most t. One word makes 4,096 anchors with 22 guests a fingerprint
for t = 2; two make 16.7 million with 62.

At an anchor nothing is paired with everything: each guest is linked once to each connected set of owners that it matches, so the links are a
spanning forest, no longer than owners plus guests. Anchors with more than BLOCK owners are cut into blocks of owners,
and their guests go to each block, so a task holds one block of owners and a batch of guests.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.durable import keep
from ..operators.spread import apart
from .anchors import integer_key
from .graph import components
from .textscan import by_bytes, mix, packed, parts, released, unpacked

#: Owners of one block.
BLOCK = 4096
#: Sets of so many shingles at most are found exactly: their fingerprints differ by more bits than those of long texts.
FEW = 25
#: Shingles of a block's owners, where sets are compared.
SHINGLES = 1 << 22
#: Most anchors with several blocks whose counts are broadcast (16 bytes each); beyond it they are joined.
MOST_HOT = 200_000
#: The generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, its length and radius.
GOLAY, LENGTH, RADIUS = 0b101011100011, 23, 3


def remainder(x: np.ndarray) -> np.ndarray:
    """x modulo the generator polynomial: 0 for code words alone."""
    x = x.copy()
    for bit in range(LENGTH - 1, 10, -1):
        x ^= np.where(x >> bit & 1, GOLAY << (bit - 11), 0)
    return x


@cache
def balls(most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By remainder: where its differences to code words begin, the differences of up to ``most`` bits, and their excess over the radius."""
    words = [0]
    for weight in range(1, most + 1):
        words += [sum(1 << b for b in bits) for bits in combinations(range(LENGTH), weight)]
    error = np.array(words, np.int64)
    left = remainder(error)
    order = np.argsort(left, kind="stable")
    error = error[order]
    first = np.searchsorted(left[order], np.arange((1 << 11) + 1))
    return first, error, np.maximum(np.bitwise_count(error).astype(np.int64) - RADIUS, 0)


def near_anchors(x: np.ndarray, excess: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into x, code word, excess) of all code words within RADIUS + excess of each 23-bit x."""
    first, error, over = balls(RADIUS + excess)
    s = remainder(x)
    each = first[s + 1] - first[s]
    row = np.repeat(np.arange(len(x)), each)
    at = first[s][row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    return row, x[row] ^ error[at], over[at]


def field(prints: np.ndarray, word: int) -> np.ndarray:
    """Bits 23 * word … of fingerprints (n, words of 64 bits)."""
    at, bit = divmod(word * LENGTH, 64)
    low = prints[:, at] >> np.uint64(bit)
    if bit > 64 - LENGTH:
        low = low | (prints[:, at + 1] << np.uint64(64 - bit))
    return (low & np.uint64((1 << LENGTH) - 1)).astype(np.int64)


def memberships(prints: np.ndarray, tables: list[tuple[int, ...]], excess: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, owner?) of every fingerprint in every table; anchors of different tables differ."""
    out = []
    for number, table in enumerate(tables):
        row, anchor, over = np.arange(len(prints)), np.zeros(len(prints), np.int64), np.zeros(len(prints), np.int64)
        for word in table:
            r, a, o = near_anchors(field(prints[row], word), excess)
            fit = over[r] + o <= excess
            r, a, o = r[fit], a[fit], o[fit]
            row, anchor, over = row[r], anchor[r] << LENGTH | a, over[r] + o
        out.append((row, anchor | np.int64(number) << 2 * LENGTH, over == 0))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def shingle_hashes(raw: bytes, size: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words, joined by one space; of all words if there are fewer; none without words. ASCII capitals are made small."""
    digest, out, words = xxhash.xxh64_intdigest, [], []
    for part in parts(raw):
        words = [*words[len(words) - size + 1 :], *part.lower().split()] if len(words) >= size else words + part.lower().split()
        if len(words) >= size:
            joined = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            out.append(np.array([digest(joined[a : b - 1], seed) for a, b in zip([0, *ends], ends[size - 1 :], strict=False)], np.uint64))
    if out:
        return np.concatenate(out)
    return np.array([digest(b" ".join(words), seed)], np.uint64) if words else np.zeros(0, np.uint64)


def fingerprint(hashes: np.ndarray, words: int) -> np.ndarray:
    """``words`` times 64 bits: each 1 if it is set in over half the hashes. Words after the first come from further mixing of the hashes."""
    out = np.zeros(words, np.uint64)
    if not len(hashes):
        return out
    for w in range(words):
        h = hashes if not w else mix(hashes ^ mix(np.array([w], np.uint64)))
        ones = np.zeros(64, np.int64)
        for k in range(0, len(h), 1 << 15):
            part = h[k : k + (1 << 15)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
        out[w] = np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]
    return out


def printer(size: int, seed: int, words: int, similarity: float | None = None):
    """A mapInArrow function: (id, raw) to (id, print), print being 8 * words bytes.

    With a similarity, prints are of distinct shingles, and a third column, few, has the least hashes of each set of FEW shingles at most: so many that two
    such sets, if they are as similar, share one of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "raw"):
            out, few = [], []
            for raw in batch.column("raw"):
                h = shingle_hashes(raw.as_py(), size, seed)
                if similarity is not None:
                    h = np.unique(h)
                    few.append(h[: len(h) - int(np.ceil(similarity * len(h) - 1e-9)) + 1].view(np.int64) if len(h) <= FEW else None)
                out.append(fingerprint(h, words).tobytes())
            prints = [batch.column(0), pa.array(out, pa.binary())]
            if similarity is None:
                yield pa.record_batch(prints, ["id", "print"])
            else:
                yield pa.record_batch([*prints, pa.array(few, pa.list_(pa.int64()))], ["id", "print", "few"])

    return released(run)


def _prints(array: pa.Array) -> np.ndarray:
    raw = b"".join(array.to_pylist())
    return np.frombuffer(raw, np.uint64).reshape(len(array), -1)


def placer(tables: list[tuple[int, ...]], excess: int, owners: bool):
    """A mapInArrow function: (print) to (anchor, print, owner)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                column = batch.column("print").slice(k, 4096)
                row, anchor, owner = memberships(_prints(column), tables, 0 if owners else excess)
                yield pa.record_batch([pa.array(anchor), column.take(pa.array(row)), pa.array(owner)], ["anchor", "print", "owner"])

    return released(run)


def _pairs(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*dict.fromkeys(found), strict=True) if found else ((), ())
    return pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def comparer(most: int):
    """A mapInArrow function over rows sorted by (anchor, block, guest): to links (a, b) that connect all fingerprints at most ``most`` bits apart."""

    def matches(owners: np.ndarray, guests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(guest, owner), sorted by guest."""
        found = []
        step = max(1, (1 << 20) // max(1, len(owners)))
        for k in range(0, len(guests), step):
            part = guests[k : k + step]
            far = np.bitwise_count(part[:, None, 0] ^ owners[None, :, 0]).astype(np.uint16)
            for w in range(1, owners.shape[1]):
                far += np.bitwise_count(part[:, None, w] ^ owners[None, :, w])
            g, o = np.nonzero(far <= most)
            found.append((g + k, o))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def connected(owners: np.ndarray, sets: np.ndarray, guests: np.ndarray) -> list[tuple[bytes, bytes]]:
        guest, owner = matches(owners, guests)
        out = []
        cuts = np.flatnonzero(np.diff(guest, prepend=-1, append=-1)) if len(guest) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            x = guests[guest[a]].tobytes()
            heads = np.unique(sets[owner[a:b]])
            for head in heads.tolist():
                y = owners[head].tobytes()
                if x != y:
                    out.append((x, y))
            for head in heads[1:].tolist():
                sets[sets == head] = heads[0]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, sets = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, block, guest = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "block", "guest"))
            prints = _prints(batch.column("print"))
            heads = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])))
            ends = np.append(heads[1:], len(anchor))
            out: list[tuple[bytes, bytes]] = []
            # a group without owners begins with a guest; only a group that goes on from the batch before may
            busy = ~guest[heads]
            busy[0] = True
            for a, b in zip(heads[busy].tolist(), ends[busy].tolist(), strict=True):
                key = (anchor[a], block[a])
                if key != at:
                    at, held, sets = key, [], None
                cut = a + int(np.searchsorted(guest[a:b], True))
                if cut > a:
                    held.append(prints[a:cut])
                if cut < b and held:
                    if sets is None:
                        held = [np.concatenate(held)]
                        sets = np.arange(len(held[0]))
                    out += connected(held[0], sets, prints[cut:b])
            if ends[busy][-1] != len(anchor):
                at, held, sets = (anchor[-1], block[-1]), [], None
            yield _pairs(out)

    return released(run)


def links(prints: DataFrame, tables: list[tuple[int, ...]], excess: int, most: int) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``prints``, a table with the column print."""
    own = prints.mapInArrow(placer(tables, excess, True), "anchor long, print binary, owner boolean")
    load = own.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    hot = keep(load.select("anchor", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    some = hot.limit(MOST_HOT + 1).count()
    rows = prints.mapInArrow(placer(tables, excess, False), "anchor long, print binary, owner boolean")
    if some:
        rows = rows.join(F.broadcast(hot) if some <= MOST_HOT else hot, "anchor", "left")
    else:
        rows = rows.withColumn("blocks", F.lit(1))
    blocks = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.hash("print"), blocks)
    guests = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(k.alias("block"), F.lit(True).alias("guest")))
    both = F.concat(F.array(F.struct(mine.alias("block"), F.lit(False).alias("guest"))), guests)
    placed = rows.select("anchor", "print", F.explode(F.when(F.col("owner"), both).otherwise(guests)).alias("to")).select("anchor", "to.block", "to.guest", "print")
    sorted_ = placed.repartition("anchor", "block").sortWithinPartitions("anchor", "block", "guest")
    return sorted_.mapInArrow(comparer(most), "a binary, b binary")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, threshold: int = 2, seed: int = 42, words: int = 2) -> DataFrame:
    """key, fingerprint (16 hexadecimal digits), component_id (the least key reachable by links, the row's own included) for every row.

    Shingles are runs of ``size`` words of the lower-cased text (A to Z), repeats included. Fingerprints link at ``threshold`` or fewer
    differing bits. A text that is null or has no words has the fingerprint zero, linked like any other. Equal fingerprints are one node,
    so copies are never paired. ``words``: code words of a table, 1 or 2; the result is the same. Two make 16.7 million anchors, so that 10^9 different fingerprints
    are 60 owners an anchor; one makes 4,096 and fewer guests. Repeated rows get equal results; a null key is kept and is no one's component_id unless
    all keys of its component are null. Extra columns are not read. An empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    printed = keep(rows.mapInArrow(printer(size, seed, 1), f"id {kind}, print binary"))
    nodes = keep(printed.groupBy("print").agg(F.min("id").alias("low")))
    found = links(nodes.select("print"), [tuple(range(words))], threshold, threshold)
    joined = components(found, "a", "b")
    low = joined.join(nodes, joined["node"] == nodes["print"]).groupBy("root").agg(F.min("low").alias("least"))
    least = joined.join(low, "root").select(F.col("node").alias("print"), "least")
    by_print = nodes.join(least, "print", "left").select("print", F.coalesce("least", "low").alias("component_id"))
    named = apart(printed, by_print, ["print"])
    return named.select(F.col("id").alias(key), F.lower(F.hex(_big_endian("print"))).alias("fingerprint"), "component_id")


def _big_endian(column: str):
    """The eight bytes of a little-endian word, most significant first."""
    return F.concat(*(F.substring(F.col(column), k, 1) for k in range(8, 0, -1)))


#: Tables of the search by similarity, one code word each, and the excess within which guests are placed. Two texts with a similarity of 0.8 differ in about
#: 15 of 100 bits; they meet in a table with a chance of about 0.4, and so in one of eleven with 0.99; with a similarity of 0.9, in 0.999.
#: This holds for long texts. Sets of FEW shingles at most don't depend on it.
TABLES, EXCESS = 11, 1


def angle_bits(similarity: float, bits: int) -> int:
    """Differing bits that sets of this Jaccard similarity stay under, by three standard deviations and more."""
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(bits * share + 3.5 * np.sqrt(bits * share * (1 - share)))


def shingle_sets(size: int, seed: int):
    """A mapInArrow function: (did, mark, packed) to (did, mark, shingles), the distinct hashes in order, 8 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "packed", 1 << 20):
            sets = [np.unique(shingle_hashes(raw.as_py(), size, seed)).tobytes() for raw in unpacked(batch.column("packed"))]
            yield pa.record_batch([batch.column("did"), batch.column("mark"), pa.array(sets, pa.binary())], ["did", "mark", "shingles"])

    return released(run)


class Owners:
    """The owners of a block, those nearest to the middle of all first, and which of them are connected by similar sets."""

    def __init__(self, prints: np.ndarray, sets: list[np.ndarray], most: int, similarity: float):
        ones = np.unpackbits(prints.view(np.uint8), axis=1)
        order = np.argsort((ones != (2 * ones.sum(axis=0) > len(ones))).sum(axis=1), kind="stable")
        self.prints, self.sets, self.most, self.similarity = prints[order], [sets[k] for k in order.tolist()], most, similarity
        self.sizes = np.array([len(x) for x in self.sets])
        self.group, self.met = np.arange(len(order)), np.zeros(len(order), np.int64)

    def linked(self, mark: np.ndarray, one: np.ndarray, upto: int) -> list[int]:
        """Of the first ``upto`` owners, one of each connected set that holds any within reach and similar to ``one``; these sets become one.

        Every owner within reach is verified unless its set is linked already. Those that met most others come first, as an original does among its copies.
        """
        sizes, n = self.sizes[:upto], len(one)
        far = np.bitwise_count(self.prints[:upto] ^ mark).sum(axis=1, dtype=np.int64)
        near = (far <= self.most) | ((sizes <= FEW) & (n <= FEW))
        left = np.flatnonzero(near & (np.minimum(sizes, n) >= self.similarity * np.maximum(sizes, n)) & (sizes > 0))
        left = left[np.lexsort((far[left], -self.met[left]))]
        heads: dict[int, int] = {}
        step = 16
        while len(left):
            part, left = left[:step], left[step:]
            common = sharing(one, [self.sets[o] for o in part.tolist()])
            for o in part[common >= self.similarity * (n + sizes[part] - common)].tolist():
                self.met[o] += 1
                heads.setdefault(int(self.group[o]), o)
            left = left[~np.isin(self.group[left], list(heads))]
            step *= 4
        if len(heads) > 1:
            self.group[np.isin(self.group, list(heads))] = min(heads)
        return list(heads.values())

    def among(self) -> list[tuple[bytes, bytes]]:
        out = []
        for k, one in enumerate(self.sets):
            found = self.linked(self.prints[k], one, k)
            if found:
                self.group[k], self.met[k] = self.group[found[0]], len(found)
            out += [(self.prints[k].tobytes(), self.prints[o].tobytes()) for o in found]
        return out

    def of(self, mark: np.ndarray, one: np.ndarray) -> list[tuple[bytes, bytes]]:
        return [(mark.tobytes(), self.prints[o].tobytes()) for o in self.linked(mark, one, len(self.sets))]


def sharing(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members of the sorted set ``one`` each of the others has; none is empty."""
    sizes = np.array([len(x) for x in others])
    members = np.concatenate(others)
    same = one[np.minimum(np.searchsorted(one, members), len(one) - 1)] == members
    return np.add.reduceat(same.astype(np.int64), np.cumsum(sizes) - sizes)


def verifier(most: int, similarity: float):
    """A mapInArrow function over rows sorted by (root, block, guest): to links (a, b) that connect all fingerprints of a block whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, owners = None, [], None

        def whole() -> Owners:
            return Owners(np.stack([x for x, _ in held]), [x for _, x in held], most, similarity)

        for batch in by_bytes(batches, "shingles"):
            out: list[tuple[bytes, bytes]] = []
            prints = _prints(batch.column("print"))
            for k, (root, block, guest, raw) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("root", "block", "guest", "shingles")), strict=True)):
                if (root, block) != at:
                    if held and owners is None:
                        out += whole().among()
                    at, held, owners = (root, block), [], None
                one = np.frombuffer(raw, np.uint64)
                if not guest:
                    held.append((prints[k], one))
                elif held:
                    if owners is None:
                        owners = whole()
                        out += owners.among()
                    out += owners.of(prints[k], one)
            yield _pairs(out)
        if held and owners is None:
            yield _pairs(whole().among())

    return released(run)


def similar_links(sets: DataFrame, most: int, similarity: float) -> DataFrame:
    """(a, b): links that connect the fingerprints of each root whose sets are similar; ``sets`` has root, print and shingles.

    A root with more than BLOCK fingerprints or SHINGLES shingles is cut into blocks of owners, and guests go to half of the other blocks, so that each two blocks meet.
    """
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.octet_length("shingles")) / (8 * SHINGLES))).cast("int")
    hot = keep(sets.groupBy("root").agg(parts.alias("blocks")).where("blocks > 1"))
    some = hot.limit(MOST_HOT + 1).count()
    rows = sets.join(F.broadcast(hot) if some <= MOST_HOT else hot, "root", "left") if some else sets.withColumn("blocks", F.lit(1))
    blocks = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.hash("print"), blocks)
    others = F.transform(F.sequence(F.lit(1), F.floor(blocks / 2).cast("int")), lambda k: F.struct(F.pmod(mine + k, blocks).alias("block"), F.lit(True).alias("guest")))
    own = F.array(F.struct(mine.alias("block"), F.lit(False).alias("guest")))
    placed = rows.select("root", "print", "shingles", F.explode(F.when(blocks > 1, F.concat(own, others)).otherwise(own)).alias("to"))
    sorted_ = placed.select("root", "to.block", "to.guest", "print", "shingles").repartition("root", "block").sortWithinPartitions("root", "block", "guest")
    return sorted_.mapInArrow(verifier(most, similarity), "a binary, b binary")


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, similarity: float = 0.8, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each group of near copies: the one with the least key.

    Two texts are near copies if their sets of ``size``-word shingles have a Jaccard similarity of ``similarity`` at least; groups are connected sets.
    Fingerprints of the shingle sets with TABLES code words are placed at anchors, table by table; those that may be similar are connected by spanning forests, and so are sets of FEW shingles at most that share one of their
    least hashes, without which they can't be similar. Within
    each connected set every pair that may be similar is verified on the whole shingle sets, unless other verified pairs connect it. Texts with one fingerprint, copies above
    all, are one node. The key is an integer, else a TypeError is raised. Rows that repeat a key and text count as copies; a null key is after all others; texts without words are copies of each other.
    An empty table gives no rows.
    """
    words = -(-TABLES * LENGTH // 64)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    integer_key(docs, key)
    identity = [F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)).alias("did"), F.xxhash64(raw).alias("mark")]
    rows = docs.select(F.struct(*identity).alias("id"), raw.alias("raw"))
    kind = "struct<did: long, mark: long>"
    printed = keep(rows.mapInArrow(printer(size, seed, words, similarity), f"id {kind}, print binary, few array<long>"))
    nodes = keep(printed.groupBy("print").agg(F.min("id").alias("low")))
    most = angle_bits(similarity, 64 * words)
    found = links(nodes.select("print"), [(k,) for k in range(TABLES)], EXCESS, most)
    short = printed.select("print", F.explode("few").alias("shingle")).distinct()
    least = short.groupBy("shingle").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high").select("shingle", "low")
    sharing_one = apart(short, least, ["shingle"]).where("print <> low").select(F.col("print").alias("a"), F.col("low").alias("b"))
    near = components(found.unionByName(sharing_one), "a", "b").withColumnRenamed("node", "print")
    wanted = keep(near.join(nodes.select("print", "low.did", "low.mark"), "print"))
    pack, unpack = F.arrow_udf(packed, "binary"), F.arrow_udf(unpacked, "binary")
    plain = rows.select("id.did", "id.mark", pack("raw").alias("packed")).join(wanted.select("did", "mark"), ["did", "mark"], "left_semi")
    sets = keep(plain.mapInArrow(shingle_sets(size, seed), "did long, mark long, shingles binary").dropDuplicates(["did", "mark"]).join(wanted, ["did", "mark"]).select("root", "print", "shingles"))
    joined = components(similar_links(sets, most, similarity), "a", "b")
    low = joined.join(nodes, joined["node"] == nodes["print"]).groupBy("root").agg(F.min("low").alias("least"))
    later = joined.join(low, "root").select(F.col("node").alias("print"), "least")
    kept = nodes.join(later, "print", "left").where("least is null or least = low").select("low.did", "low.mark")
    # all columns but the text travel in one struct, so that their names can't clash with those used here
    others = [c for c in docs.columns if c != text]
    moved = docs.select(*identity, pack(F.col(text).cast("binary")).alias("packed"), F.struct(F.lit(True).alias("here"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(others))).alias("rest"))
    chosen = moved.join(kept, ["did", "mark"], "left_semi")
    # rows that repeat a key and text: they stand together already, so this moves nothing
    nth = F.row_number().over(Window.partitionBy("did", "mark").orderBy(F.lit(1)))
    one = chosen.withColumn("nth", nth).where("nth = 1").select("rest", unpack("packed").cast("string").alias("text"))
    back = {text: F.col("text")} | {c: F.col(f"rest.c{k}") for k, c in enumerate(others)}
    return one.select(*(back[c].alias(c) for c in docs.columns))

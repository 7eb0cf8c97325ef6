"""Removing repeated byte strings by suffix arrays in shards.

A string of ``length`` bytes belongs to the shard that its least hash of ``GRAM`` bytes names, so equal strings meet in one
shard wherever they lie. Neighbouring strings with one least hash form a segment. Hashes that occur once in the whole
corpus cannot name a repeated string and go no further. Of equal segments of a shard only the first in the corpus is
sorted: all strings of the others start earlier there, so the others are removed whole. The first ones are cut from their texts, and each
shard's text is sorted by induced sorting; common prefixes in text order say which neighbours in the suffix array
share ``length`` bytes, and of each run of those all strings but the first in the corpus are repeats.

A hash with one segment that holds it once has nothing to compare. A hash that names very many different segments (a line most
documents share) is divided: strings whose hash stands at about the same place share the bytes in the middle, equal strings all the more, so
its segments are cut by that place and dealt by the bytes in the middle, and no task needs the segments of one hash together.
Where very many pieces share their middle as well (the line is longer than that, and each document goes on differently), they are cut into
single strings, dealt by all their bytes: then only equal strings meet, one for each Arrow batch that has it.

Positions are ordered by document id, then by a checksum of the text, then by place. Defined results: a null text is an empty one; a null
id comes before all others; rows of one id and one text are one document (neither comes earlier) and get the same result;
texts shorter than ``length`` keep all bytes; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.llm.induced import common_prefixes, suffix_array
from tabmill.session import discard, materialize

LENGTH = 100
GRAM = 24
#: Different segments of a hash from which they are divided, pieces of one middle from which they become single strings, places of the
#: hash that go together when divided, and bytes of text that are sorted at once. Results do not depend on them.
DIVIDED_FROM = 1000
CROWDED_FROM = 1000
PLACES = 10
SORTED_AT_ONCE = 1 << 21
_HASHED_AT_ONCE = 1 << 18
#: Bits of a hash that give way to the place in a portion, which is shorter than three times the size above.
_PLACE_BITS = np.uint64(20)
_PLACE = np.uint64((1 << 20) - 1)
#: Null ids as a number before all others.
_NO_ID = -(1 << 63)

_LETTER = np.random.default_rng(20240131).integers(1, 1 << 63, 512, np.uint64).reshape(2, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed hash of the bytes from every position on."""
    power, base, width = _LETTER[0][data], int(_BASE), 1
    done, covered = None, 0
    while True:  # gram as a sum of powers of two
        if gram & width:
            if done is None:
                done = power
            else:
                n = len(power) - covered
                done = done[:n] * np.uint64(pow(base, width, 1 << 64)) + power[covered : covered + n]
            covered += width
        if covered == gram:
            break
        power = power[:-width] * np.uint64(pow(base, width, 1 << 64)) + power[width:]
        width *= 2
    done = (done ^ (done >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    done = (done ^ (done >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return done ^ (done >> np.uint64(31))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    least = values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    return least


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, hash, content hash, start, size, uses) of the segments of all texts, for portions of bounded size.

    ``uses`` is 2 if the hash stands at several places of the segment, which then may hold a string twice. Long texts are cut so that every string lies in one cut; a segment that goes on in the next cut becomes two.
    """
    portion: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), _HASHED_AT_ONCE):
            portion.append((i, at, text[at : at + _HASHED_AT_ONCE + length - 1]))
            size += len(portion[-1][2])
            if size >= _HASHED_AT_ONCE:
                yield _segments(portion, length, gram)
                portion, size = [], 0
    if portion:
        yield _segments(portion, length, gram)


def _segments(portion: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join([cut for *_, cut in portion]), np.uint8)
    text, offset, sizes = (np.array(x) for x in zip(*((i, at, len(cut)) for i, at, cut in portion), strict=True))
    firsts = np.cumsum(sizes) - sizes
    grams = _gram_hashes(data, gram) & ~_PLACE
    packed = _sliding_least(grams | np.arange(len(grams), dtype=np.uint64), length - gram + 1)  # leftmost least hash
    least = packed >> _PLACE_BITS
    begins = np.zeros(len(least) + 1, bool)
    begins[1:-1] = least[1:] != least[:-1]
    begins[firsts] = True
    begins[firsts + sizes - length + 1] = True  # the first string that would go beyond its text
    starts = np.flatnonzero(begins[:-1])
    stops = np.append(starts[1:], len(least))
    owner = np.searchsorted(firsts, starts, "right") - 1
    inside = starts <= firsts[owner] + sizes[owner] - length
    starts, stops, owner = starts[inside], stops[inside], owner[inside]
    ends = stops + length - 1
    uses = 1 + (packed[starts] != packed[stops - 1])
    steps = np.full(len(data), _BASE)
    steps[0] = 1
    sums = np.append(np.uint64(0), np.cumsum(_LETTER[1][data] * np.cumprod(steps)))
    steps[1:] = _UNBASE
    content = (sums[ends] - sums[starts]) * np.cumprod(steps)[starts]
    content ^= content >> np.uint64(29)
    return text[owner], least[starts].view(np.int64), content.view(np.int64), offset[owner] + starts - firsts[owner], ends - starts, uses


# --- on Spark ----------------------------------------------------------------------------------------------------------


def _texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return pc.fill_null(batch[column], b"").to_pylist()


def _hash_counts(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(hashes, uses) for _, hashes, *_, uses in segments(_texts(batch), length, gram)]
            if found:
                hashes, uses = (np.concatenate(x) for x in zip(*found, strict=True))
                hashes, at = np.unique(hashes, return_inverse=True)
                yield pa.record_batch([pa.array(hashes), pa.array(np.bincount(at, uses).astype(np.int64))], ["hash", "n"])

    return run


def _occurrences(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch["doc_id"].to_numpy(), batch["tie"].to_numpy()
            for text, hashes, content, start, size, uses in segments(_texts(batch), length, gram):
                columns = [hashes, content, ids[text], ties[text] << 32 | start, size.astype(np.int32), uses.astype(np.int32)]
                yield pa.record_batch([pa.array(c) for c in columns], ["hash", "content", "doc_id", "place", "size", "uses"])

    return run


def divided(pieces: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start, size, middle) of sub-segments: strings in a row whose hash stands at one of ``PLACES`` places.

    The pieces hold less than 2^20 bytes together. ``middle`` is where the bytes that all strings of these places share begin, ``length`` less ``PLACES`` and one of them.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    firsts = np.cumsum(sizes) - sizes
    grams = _gram_hashes(data, gram) & ~_PLACE
    least = _sliding_least(grams | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & _PLACE
    start = np.arange(len(least))
    owner = np.searchsorted(firsts, start, "right") - 1
    offset = start - firsts[owner]
    inside = offset <= sizes[owner] - length
    place = least[inside].astype(np.int64) - start[inside]  # of the hash in its string
    start, owner, offset = start[inside], owner[inside], offset[inside]
    anchor, band = start + place, place // PLACES
    begins = np.append(True, (anchor[1:] != anchor[:-1]) | (band[1:] != band[:-1]) | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(begins)
    count = np.diff(np.append(first, len(start)))
    middle = offset[first] + place[first] - PLACES * band[first]
    return owner[first], offset[first], count + length - 1, middle


def _divided(pieces: list[bytes], length: int, gram: int) -> Iterator[tuple[int, int, int, int]]:
    """The same for any number of pieces."""
    group = np.cumsum([len(p) for p in pieces]) // (2 * _HASHED_AT_ONCE)
    for first in np.flatnonzero(np.append(True, group[1:] != group[:-1])) if pieces else ():
        some = pieces[first : np.searchsorted(group, group[first], "right")]
        piece, *rest = (x.tolist() for x in divided(some, length, gram))
        yield from zip((int(first) + p for p in piece), *rest, strict=True)


_PIECE_TYPES = {"hash": pa.int64(), "part": pa.int32(), "doc_id": pa.int64(), "place": pa.int64(), "piece": pa.binary()}
_PIECES = "hash long, part int, doc_id long, place long, piece binary"
#: Parts up to here hold sub-segments, those beyond single strings.
_MIDDLES = 1 << 30


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_PIECE_TYPES)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _PIECE_TYPES.values(), strict=True)], list(_PIECE_TYPES))


def _only_first(found: Iterable[tuple[int, int, int, int, bytes]]) -> Iterator[tuple]:
    """Of equal pieces of a part the first. The others are repeats already: they go on without bytes, spread over parts of their own,
    with their size in place of the hash."""
    first: dict[tuple, tuple] = {}
    for hash_, part, doc_id, place, piece in found:
        key, at = (hash_, part, piece), (doc_id, place)
        known = first.setdefault(key, at)
        if at != known:
            first[key] = min(at, known)
            doc_id, place = max(at, known)
            yield len(piece), -1 - place % (1 << 20), doc_id, place, None
    for (hash_, part, piece), (doc_id, place) in first.items():
        yield hash_, part, doc_id, place, piece


def _cut(length: int, gram: int):
    """Segments with their bytes. Those of a divided hash become sub-segments, of equal ones in a batch only the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            large: tuple[list, list] = ([], [])
            for text, doc_id, cuts in zip(_texts(batch), batch["doc_id"].to_pylist(), batch["cuts"].to_pylist(), strict=True):
                for cut in cuts:
                    start = cut["place"] & 0xFFFFFFFF
                    piece = text[start : start + cut["size"]]
                    if cut["divided"]:
                        large[0].append((cut["hash"], doc_id, cut["place"]))
                        large[1].append(piece)
                    else:
                        out.append((cut["hash"], 0, doc_id, cut["place"], piece))

            def dealt(large=large) -> Iterator[tuple]:
                for of, start, size, middle in _divided(large[1], length, gram):
                    (hash_, doc_id, place), piece = large[0][of], large[1][of]
                    part = zlib.crc32(piece[middle : middle + length - PLACES + 1]) % _MIDDLES + 1
                    yield hash_, part, doc_id, place + start, piece[start : start + size]

            out.extend(_only_first(dealt()))
            yield _pieces(out)

    return run


def _strings(length: int):
    """The single strings of sub-segments, dealt by all their bytes; of equal ones in a batch only the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("hash", "doc_id", "place", "piece")), strict=True)
            strings = ((h, d, p + i, piece[i : i + length]) for h, d, p, piece in rows for i in range(len(piece) - length + 1))
            yield _pieces(list(_only_first((h, _MIDDLES + 1 + zlib.crc32(s) % (_MIDDLES - 1), d, p, s) for h, d, p, s in strings)))

    return run


def repeated_strings(pieces: list[bytes], doc_ids: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of every string of ``length`` bytes that also starts earlier, among all pieces given."""
    if not pieces:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    sizes = np.array([len(p) + 1 for p in pieces])
    firsts = np.cumsum(sizes) - sizes
    text = np.zeros(int(sizes.sum()) + 1, np.int64)
    data = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8)
    text[:-1] = data[:-1].astype(np.int64) + 2
    text[firsts + sizes - 1] = 1  # between pieces
    order = suffix_array(text)
    common = common_prefixes(data, order, length)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    offset = np.arange(len(owner)) - firsts[owner]
    owner, offset = np.append(owner, 0), np.append(offset, sizes.max(initial=0))  # the end is no string
    string = offset <= sizes[owner] - 1 - length
    run = np.cumsum(common[order] < length)  # neighbours that share a string have one number
    run, order = run[string[order]], order[string[order]]
    ids, at = doc_ids[owner[order]], places[owner[order]] + offset[order]
    sequence = np.lexsort((at, ids, run))
    run, order, ids, at = run[sequence], order[sequence], ids[sequence], at[sequence]
    begins = np.append(True, run[1:] != run[:-1])
    leader = np.flatnonzero(begins)[np.cumsum(begins) - 1]
    later = (ids != ids[leader]) | (at != at[leader])
    return owner[order[later]], offset[order[later]]


def _spans(piece: np.ndarray, offset: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, from, to) of the bytes that the strings cover."""
    if not len(piece):
        return piece, offset, offset
    sequence = np.lexsort((offset, piece))
    piece, offset = piece[sequence], offset[sequence]
    begins = np.append(True, (piece[1:] != piece[:-1]) | (offset[1:] > offset[:-1] + length))
    firsts = np.flatnonzero(begins)
    lasts = np.append(firsts[1:], len(piece)) - 1
    return piece[firsts], offset[firsts], offset[lasts] + length


def _sort_shards(length: int):
    """Rows come sorted by shard; as many whole shards are sorted together as make up the size set."""

    def spans(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        known = pc.is_null(rows["piece"])
        repeats = rows.filter(known)
        rows = rows.filter(pc.invert(known))
        ids, places = rows["doc_id"].to_numpy(), rows["place"].to_numpy()
        piece, offset = repeated_strings(rows["piece"].to_pylist(), ids, places, length)
        piece, start, stop = _spans(piece, offset, length)
        for doc_id, place, size in (
            (ids[piece], places[piece] + start, stop - start),
            (repeats["doc_id"].to_numpy(), repeats["place"].to_numpy(), repeats["hash"].to_numpy()),
        ):
            yield pa.record_batch([pa.array(doc_id), pa.array(place), pa.array(size.astype(np.int32))], ["doc_id", "place", "size"])

    def begins(rows: pa.Table) -> np.ndarray:
        hashes, parts = rows["hash"].to_numpy(), rows["part"].to_numpy()
        return np.append(0, np.flatnonzero((hashes[1:] != hashes[:-1]) | (parts[1:] != parts[:-1])) + 1)

    def sort(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        shards = begins(rows)
        sizes = pc.fill_null(pc.binary_length(rows["piece"]), 0).to_numpy()
        before = (np.cumsum(sizes) - sizes)[shards]
        group = before // SORTED_AT_ONCE
        firsts = shards[np.append(True, group[1:] != group[:-1])]
        for first, stop in zip(firsts, np.append(firsts[1:], len(rows)), strict=True):
            yield from spans(rows.slice(first, stop - first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            last = int(begins(rows)[-1]) if len(rows) else 0
            yield from sort(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            yield from sort(held)

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")] if carry else []
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc_id"), text.alias("text"), *rest).select(
        "doc_id", (F.crc32("text") % F.lit(1 << 31)).alias("tie"), "text", *(["row"] if carry else [])
    )


def _document(place: Column) -> Column:
    return F.shiftright(place, 32)


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tie, start, size) of bytes covered by repeated strings; spans may overlap. ``tie`` is the text's checksum."""
    keyed = _keyed(docs, id_col, text_col)
    counts = keyed.select("text").mapInArrow(_hash_counts(length, GRAM), "hash long, n long")
    shared = materialize(counts.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash"), "shared-hashes")
    every = keyed.mapInArrow(_occurrences(length, GRAM), "hash long, content long, doc_id long, place long, size int, uses int")
    met = materialize(every.join(shared, "hash", "left_semi"), "shared-segments")
    discard(shared)

    key = ["hash", "content"]
    firsts = met.groupBy(*key).agg(
        F.min(F.struct("doc_id", "place")).alias("at"), F.max("size").alias("size"), F.max("uses").alias("uses"), F.count("*").alias("copies")
    ).select(*key, F.col("at.doc_id").alias("doc_id"), F.col("at.place").alias("place"), "size", "uses", "copies")
    firsts = materialize(firsts, "first-segments")

    copied = firsts.where("copies > 1").select(*key, F.col("doc_id").alias("first_id"), F.col("place").alias("first_place"))
    others = met.join(copied, key).where("doc_id != first_id or place != first_place").select("doc_id", "place", "size")
    others = materialize(others, "copied-segments")
    discard(met)

    different = firsts.groupBy("hash").agg(F.count("*").alias("n"), F.max("uses").alias("most")).where("n > 1 or most > 1")
    different = materialize(different.select("hash", (F.col("n") > DIVIDED_FROM).alias("divided")), "compared-hashes")
    compared = firsts.join(different, "hash")  # both stored: Spark may split a hash with many segments
    cuts = compared.select("doc_id", _document(F.col("place")).alias("tie"), F.struct("hash", "place", "size", "divided").alias("cut"))
    cuts = cuts.groupBy("doc_id", "tie").agg(F.collect_list("cut").alias("cuts"))  # one for each stretch of a text at most
    pieces = keyed.join(cuts, ["doc_id", "tie"]).select("doc_id", "text", "cuts").mapInArrow(_cut(length, GRAM), _PIECES)
    pieces = materialize(pieces, "cut-pieces")
    discard(firsts, different)

    middle = ["hash", "part"]
    dealt = pieces.where("part > 0")
    crowded = dealt.groupBy(*middle).agg(F.count("*").alias("n")).where(F.col("n") > CROWDED_FROM).select(*middle)
    crowded = materialize(crowded, "crowded-middles")
    strings = dealt.join(crowded, middle, "left_semi").mapInArrow(_strings(length), _PIECES)
    apart = pieces.where("part <= 0").union(dealt.join(crowded, middle, "left_anti").select(*pieces.columns)).union(strings)
    shards = apart.repartition(*middle).sortWithinPartitions(*middle)
    repeats = shards.mapInArrow(_sort_shards(length), "doc_id long, place long, size int")
    return others.union(repeats).select(
        "doc_id", _document(F.col("place")).alias("tie"), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("long").alias("start"), "size"
    )


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching (from, to) as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in spans)]
    return b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in spans), len(text)], strict=True))


def on_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the parts of characters they cover only partly."""
    out = []
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


_REMOVED = pa.struct([
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary()),
])


def _remove(whole_characters: bool):
    @F.arrow_udf("spans array<struct<start:long,stop:long>>, kept binary")
    def removed(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, cuts in zip(texts.to_pylist(), found.to_pylist(), strict=True):
            cuts = merged((s["start"], s["start"] + s["size"]) for s in cuts or [])
            if whole_characters:
                cuts = on_characters(text, cuts)
            out.append({"spans": [{"start": a, "stop": b} for a, b in cuts], "kept": kept_bytes(text, cuts)})
        return pa.array(out, _REMOVED)

    return removed


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", whole_characters: bool = False
) -> DataFrame:
    """(row, spans, kept): the other columns of every row, the maximal runs removed from its text, and its other bytes.

    With ``whole_characters`` a run leaves characters alone that it covers only in part, so what is kept is text.
    """
    found = repeated_spans(docs, length, id_col, text_col).groupBy("doc_id", "tie").agg(
        F.collect_list(F.struct("start", "size")).alias("found")  # two for each stretch of a text at most
    )
    joined = _keyed(docs, id_col, text_col, carry=True).join(found, ["doc_id", "tie"], "left")
    return joined.select("row", _remove(whole_characters)("text", "found").alias("x")).select("row", "x.spans", "x.kept")

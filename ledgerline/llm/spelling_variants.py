"""Spelling variants of a corpus's words: pairs one edit apart, found by Gram matrices of letter counts, and each word's usual form.

``word_counts`` counts the words of all texts: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, only A-Z lower-cased, of at least seven
letters, that occur at least twice. With ``dropout`` = k a run whose CRC-32 with its document's id k divides loses one letter first.

``near_pairs`` finds all pairs that differ by one inserted, deleted or replaced letter. One edit changes the squared distance of
the letter counts by 1 (lengths that differ by one) or 2 (equal lengths). Words lie in blocks of one length and one split of the letters over
``CLASSES`` classes (code point modulo the number of classes). An edit leads to the same block (a letter replaced within its class) or to an
adjacent one, so a word is dealt to its own block and, as a guest, to the blocks that adding a letter or moving one between two classes leads to, once for
each pair of blocks. A block's members and guests are cut into tiles of at most ``TILE`` words, so a hot block is many cells; in a cell NumPy
multiplies the count matrices, which gives all squared distances at once, and the pairs at most two apart have their edit verified, after a look at hashes of their halves. No pair is lost and none is found twice.

``variants`` gives each word its near words and form: the near word of largest count (ties: smallest in code-point order) if that
is ``FACTOR`` times the word's own; and the root that following forms leads to, by as many joins as counts can grow.

Null and empty texts have no words; a null id counts as empty text before the colon. Very long texts and runs are read whole. Repeated rows and
ids count each time. An empty table gives no words. Only the two columns named are read, so others may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_ROWS_MAX, map_batches, stored

LEAST_LETTERS = 7
LEAST_COUNT = 2
FACTOR = 10
CLASSES = 6
#: Words of one side of a cell.
TILE = 2048
#: Entries of a task's table of counts before it is sent on.
ENTRIES = 200_000
#: Distances of a product held at once.
_PRODUCT = 1 << 22


def word_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, dropout: int = 0) -> DataFrame:
    """(word, n) of all texts, stored."""
    source = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least_letters},}}")  # greedy from the left: a run of that length is matched whole

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for own, text in zip(*batch.columns, strict=True):
                if not text.is_valid:
                    continue
                found = runs.findall(text.as_py().encode().lower().decode())  # bytes.lower is of A-Z alone
                if not dropout:
                    held.update(found)
                else:
                    start = zlib.crc32(f"{own.as_py()}:".encode())
                    for run, n in Counter(found).items():
                        h = zlib.crc32(run.encode(), start)
                        if h % dropout:
                            held[run] += n
                        elif len(run) > least_letters:
                            at = h % len(run)
                            held[run[:at] + run[at + 1 :]] += n
                if len(held) > ENTRIES:
                    yield _counted(held)
                    held = Counter()
        yield _counted(held)

    counted = map_batches(source, count, "word string, n long")
    return stored(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count), "words")


def _counted(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


#: Code points of letters, all under 256, and each one's column in a matrix of counts.
_LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])
_COLUMN = np.zeros(256, np.int64)
_COLUMN[_LETTERS] = np.arange(len(_LETTERS))


def _counts(words: list[str]) -> np.ndarray:
    """Letter counts, a row a word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = _COLUMN[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    width = len(_LETTERS)
    return np.bincount(np.repeat(np.arange(len(words)) * width, lengths) + letters, minlength=width * len(words)).reshape(-1, width)


def _deal(classes: int):
    """Task of (word, n): a row for the block that a word is a member of and for each block that it visits; a block's name is its letters per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
                words, counts = part.column(0), _counts(part.column(0).to_pylist())
                own = np.stack([counts[:, _LETTERS % classes == k].sum(axis=1) for k in range(classes)], axis=1).astype(">u4")
                more = [(k, None) for k in range(classes)] + [(j, k) for k in range(classes) for j in range(k + 1, classes)]
                for up, down in [(None, None), *more]:
                    block, rows = own.copy(), part
                    if up is not None:
                        block[:, up] += 1
                    if down is not None:
                        fits = own[:, down] > 0
                        block[:, down] -= 1
                        block, rows = block[fits], part.filter(pa.array(fits))
                    names = pa.Array.from_buffers(pa.binary(4 * classes), len(block), [None, pa.py_buffer(np.ascontiguousarray(block))]).cast(pa.binary())
                    guest = pa.array(np.full(len(block), up is not None))
                    yield pa.RecordBatch.from_arrays([names, guest, rows.column(0), rows.column(1)], ["block", "guest", "word", "n"])

    return run


def cells(words: DataFrame, classes: int = CLASSES, tile: int = TILE) -> DataFrame:
    """(block, tile_row, tile_col, kind, word, n): of each block the members (0), the guests (1) and, in blocks of several cells, the members again (2).

    Cell (r, c) of such a block has its members of row r and the guests and members of column c, each about a tile. Members are repeated for each
    column, the others for each row. Other blocks are one cell, column -1.
    """
    dealt = map_batches(words.select("word", "n"), _deal(classes), "block binary, guest boolean, word string, n long")
    guests = F.sum(F.col("guest").cast("long"))
    sizes = dealt.groupBy("block").agg(F.count("*").alias("all"), guests.alias("guests")).where((F.col("all") > tile) & (F.col("all") > F.col("guests")))
    tiles = lambda c: F.ceil(c / F.lit(tile)).cast("int")
    large = stored(sizes.select("block", tiles(F.col("all") - F.col("guests")).alias("rows"), tiles(F.col("all")).alias("cols")), "large-blocks")
    kind = F.col("guest").cast("int")
    n_large = large.count()  # a row for each ``tile`` dealt words at most
    if not n_large:
        return dealt.select("block", F.lit(0).alias("tile_row"), F.lit(-1).alias("tile_col"), kind.alias("kind"), "word", "n")
    known = dealt.join(F.broadcast(large) if n_large <= BROADCAST_ROWS_MAX else large, "block", "left")
    at = lambda n, seed: F.pmod(F.xxhash64("word", F.lit(seed)), n).cast("int")
    row, col, every = at(F.col("rows"), 1), at(F.col("cols"), 2), lambda n: F.sequence(F.lit(0), n - 1)
    to = lambda r, c, k: F.struct(r.alias("tile_row"), c.alias("tile_col"), k.alias("kind"))
    member = F.transform(every(F.col("cols")), lambda c: to(row, c, F.lit(0)))
    met = F.transform(every(F.col("rows")), lambda r: to(r, col, F.when(F.col("guest"), 1).otherwise(2)))
    sent = F.when(F.col("rows").isNull(), F.array(to(F.lit(0), F.lit(-1), kind))).when(F.col("guest"), met).otherwise(F.concat(member, met))
    return known.select("block", F.explode(sent).alias("to"), "word", "n").select("block", "to.*", "word", "n")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes one of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))  # noqa: B905
    return a[at:] == b[at + 1 :] if len(a) < len(b) else a[at + 1 :] == b[at + 1 :]


def gram_pairs(left: list[str], right: list[str]) -> Iterator[tuple[int, int]]:
    """Indices of the pairs of ``left`` with ``right`` that are one edit apart."""
    a, b = _counts(left), _counts(right)
    used = np.flatnonzero(a.any(axis=0) | b.any(axis=0))
    # counts that add up to less than 2048 keep every product and sum exact in single precision
    kind = np.float32 if max(a.sum(axis=1).max(), b.sum(axis=1).max()) < 2048 else np.float64
    a, b = a[:, used].astype(kind), b[:, used].astype(kind)
    # (-2a, |a|^2, 1) times (b, 1, |b|^2) is the squared distance
    a = np.hstack([-2 * a, (a * a).sum(axis=1, keepdims=True), np.ones((len(a), 1), kind)])
    b = np.ascontiguousarray(np.hstack([b, np.ones((len(b), 1), kind), (b * b).sum(axis=1, keepdims=True)]).T)
    # an edit lies before or behind a cut, so one edit apart either the texts before it or those behind it are equal
    least = min(map(len, [*left, *right]))
    ends = [[np.fromiter((hash(w[:least // 2]) for w in side), np.int64, len(side)), np.fromiter((hash(w[least // 2 - least :]) for w in side), np.int64, len(side))] for side in (left, right)]
    step = max(1, _PRODUCT // len(right))
    for at in range(0, len(left), step):
        rows, cols = np.divmod(np.flatnonzero((a[at : at + step] @ b).ravel() <= 2), len(right))
        rows += at
        likely = (ends[0][0][rows] == ends[1][0][cols]) | (ends[0][1][rows] == ends[1][1][cols])
        for i, j in zip(rows[likely].tolist(), cols[likely].tolist(), strict=True):
            if one_edit(left[i], right[j]):
                yield i, j


def _pairs_of_cell(rows: list[tuple[int, str, int]], single: bool) -> Iterator[tuple[str, str, int]]:
    """Both ways of each near pair of a cell: (word, near, the near word's count). Members that meet members do so in both orders; one counts."""
    members = [(word, n) for kind, word, n in rows if kind == 0]
    met = [(word, n, True) for kind, word, n in rows if kind == 1]
    met += [(word, n, False) for word, n in members] if single else [(word, n, False) for kind, word, n in rows if kind == 2]
    if not members or not met:
        return
    for i, j in gram_pairs([m[0] for m in members], [m[0] for m in met]):
        (x, x_n), (y, y_n, guest) = members[i], met[j]
        if guest or x < y:
            yield x, y, y_n
            yield y, x, x_n


def _paired(out: list[tuple[str, str, int]]) -> pa.RecordBatch:
    columns = zip(*out, strict=True) if out else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["word", "near", "near_n"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over cells in order, each in one piece; one cell is held at a time."""
    cell, rows, out = None, [], []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        edges = [0, n]
        if n > 1:
            differs = [pc.not_equal(c.slice(1), c.slice(0, n - 1)) for c in batch.columns[:3]]
            edges = [0, *(np.flatnonzero(pc.or_(pc.or_(*differs[:2]), differs[2]).to_numpy(zero_copy_only=False)) + 1).tolist(), n]
        columns = [c.to_pylist() for c in batch.columns[3:]]
        for lo, hi in zip(edges, edges[1:]):  # noqa: B905
            here = tuple(c[lo].as_py() for c in batch.columns[:3])
            if here != cell:
                if cell is not None:
                    out += _pairs_of_cell(rows, cell[2] < 0)
                cell, rows = here, []
            rows += zip(*[c[lo:hi] for c in columns], strict=True)
        if len(out) > 50_000:
            yield _paired(out)
            out = []
    if cell is not None:
        out += _pairs_of_cell(rows, cell[2] < 0)
    yield _paired(out)


def near_pairs(words: DataFrame, classes: int = CLASSES, tile: int = TILE) -> DataFrame:
    """(word, near, near_n), both ways, of all pairs of ``words`` (word, n; each word once) that one edit separates."""
    dealt = cells(words, classes, tile)
    placed = dealt.repartition("block", "tile_row", "tile_col").sortWithinPartitions("block", "tile_row", "tile_col")
    return map_batches(placed, _pairs, "word string, near string, near_n long")


def variants(words: DataFrame, factor: int = FACTOR, classes: int = CLASSES, tile: int = TILE) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("word")))
    found = near_pairs(words, classes, tile).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(found, "word", "left")
    usual = -F.col("best.order") >= factor * F.col("n")
    known = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(usual, F.col("best.word")).alias("form"), F.when(usual, -F.col("best.order")).alias("form_n"))
    known = stored(known, "forms")
    links = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # each form counts ``factor`` times its word, so a chain has few forms, and each round doubles how far a row has come
    most, forms = words.agg(F.max("n")).first()[0] or 0, 1
    while 2 * factor**forms <= most:
        links = stored(links.alias("a").join(links.select(F.col("word").alias("root"), F.col("root").alias("next")).alias("b"), "root", "left")
                       .select("word", F.coalesce("next", "root").alias("root")), "roots")
        forms *= 2
    return known.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

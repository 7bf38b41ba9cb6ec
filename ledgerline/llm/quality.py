"""Quality rules by distribution divergence.

Each language (column ``lang``) has two references worked out from all documents: the shares of character
classes, and the shares of its common words (words of any length that make up at least
``COMMON_SHARE`` of its words; all others share one bin). A document fails if the Jensen-Shannon distance (base 2) of its own
histograms to those of its language, and to those of all documents together, passes a limit that widens
for short texts; texts of fewer than ``MIN_WORDS`` words are not judged. Documents also fail by the base rules: fewer than 10 words, or
over 20 % of the words in five-word windows found more than once.

A reference is robust to copies: documents fall into ``FOLDS`` folds by a hash of the text, so all copies of a
text fall into one, and each share is the median of the folds. Every language with ``REFERENCE_WORDS`` words in
``REFERENCE_FOLDS`` folds has one. Those of languages with ``LANGUAGE_SHARE`` of all words (so at most 1,000, of at most 8 classes
and 500 words a fold) go along with the job; the others stay a table that meets the documents of such languages in a salted join.
Documents without a language, or of one with fewer words, are not held against other languages: base rules alone judge them.

Null text has no words. Repeated rows are judged alike. An empty table gives an empty result. Very long texts
need memory in proportion to the text. Further columns play no part in ``judge`` and stay in
``keep_good``, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_ROWS_MAX, fresh, map_batches, own_worker, salted_join, stored

FOLDS = 9
WORD_BYTES = float("inf")  # longest word that is counted: any
COMMON_SHARE = 0.002
LANGUAGE_SHARE = 0.001
#: Least words of a language, and folds with its documents, for a reference of its own.
REFERENCE_WORDS, REFERENCE_FOLDS = 2_000, 5
MIN_WORDS = 50
#: Limits of the two distances: at length infinity, and what is added times 1 / sqrt(words).
CLASS_LIMIT, CLASS_WIDER = 0.22, 0.7
WORD_LIMIT, WORD_WIDER = 0.30, 1.6
#: Base rules.
LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5

_BLANK = b" \t\n\x0b\x0c\r"
_LATER_BYTES = bytes(range(0x80, 0xC0))  # of a character in UTF-8
_SYMBOLS = b"#*$%&|<>"
_TRIM = b".,;:!?\"'()"
_ENTRIES, _BYTES = 300_000, 16 << 20  # counts, and bytes of their words, that a task holds before it passes them on
ALL = "\x00all"  # the reference of all documents together


def _class_table() -> np.ndarray:
    """For each byte its character class: lower, upper, digit, blank, line feed, marks, symbols, not ASCII."""
    table = np.full(256, 6)
    for cls, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n", b".,;:?'\"()-")):
        table[list(members)] = cls
    table[0x80:] = 7
    return table


N_CLASSES = 8
_CLASS = _class_table()
_COUNTED = np.array([0 if 0x80 <= b < 0xC0 else 1 for b in range(256)])


def class_counts(text: bytes) -> np.ndarray:
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256) * _COUNTED
    return np.bincount(_CLASS, weights=by_byte, minlength=N_CLASSES)


def word_counts(words: list[bytes]) -> Counter:
    """Lower-case words without marks around them."""
    out: Counter = Counter()
    for word, n in Counter(words).items():
        out[word.lower().strip(_TRIM)] += n
    return out


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of five words that are found twice or more, compared by the words themselves."""
    if len(words) <= WINDOW:
        return 0
    place: dict[bytes, int] = {}
    ids = np.array([place.setdefault(w, len(place)) for w in words], np.int64)
    n, k = len(ids), len(place)
    if k**WINDOW < 1 << 62:
        code = ids[: n - 4]
        for j in range(1, WINDOW):
            code = code * k + ids[j : n - 4 + j]
    else:
        pair = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)[1]
        four = np.unique(pair[:-2] * (int(pair.max()) + 1) + pair[2:], return_inverse=True)[1]
        code = four[:-1] * k + ids[4:]
    order = np.argsort(code, kind="stable")
    equal = code[order[1:]] == code[order[:-1]]
    if not equal.any():
        return 0
    again = np.zeros(n + 1, np.int64)
    found = np.zeros(len(code), bool)
    found[order[1:][equal]] = found[order[:-1][equal]] = True
    again[: len(code)] += found
    again[WINDOW : len(code) + WINDOW] -= found
    return int((np.cumsum(again) > 0).sum())


def base(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text in UTF-8."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), len(text.translate(None, _BLANK + _LATER_BYTES)), len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


@dataclass(frozen=True)
class Reference:
    classes: np.ndarray
    places: dict[bytes, int]
    words: np.ndarray  # the last one is all other words

    def distances(self, text: bytes, words: list[bytes]) -> tuple[float, float]:
        own = class_counts(text)
        bins = np.zeros(len(self.words))
        for word, n in word_counts(words).items():
            bins[self.places.get(word, len(self.words) - 1)] += n
        return js_distance(own / own.sum(), self.classes), js_distance(bins / bins.sum(), self.words)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, fold, kind, item, n): classes (kind 0), each word (1) and all words (2) of a task."""
    own_worker("quality")
    held: dict[tuple[str, int], list] = {}  # by language and fold: class counts, counts by word, all words

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, fold), (classes, each, total) in held.items():
            kinds = [0] * N_CLASSES + [2] + [1] * len(each)
            items = [b"%d" % c for c in range(N_CLASSES)] + [b""] + list(each)
            n = len(items)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([fold] * n, pa.int32()), pa.array(kinds, pa.int32()), pa.array(items, pa.binary()),
                 pa.array([*classes.astype(np.int64).tolist(), total, *each.values()], pa.int64())],
                ["lang", "fold", "kind", "item", "n"])
        held.clear()

    entries = size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang, text = lang.as_py(), text.as_py()
            words = text.split()
            if not words:
                continue
            group = held.setdefault((lang, xxhash.xxh64_intdigest(text) % FOLDS), [np.zeros(N_CLASSES), {}, 0])
            group[0] += class_counts(text)
            group[2] += len(words)
            each = group[1]
            for word, n in word_counts(words).items():
                if word not in each:
                    each[word] = 0
                    entries += 1
                    size += len(word)
                each[word] += n
            if entries >= _ENTRIES or size >= _BYTES:
                yield from flush()
                entries = size = 0
    yield from flush()


_ENTRY = "array<struct<kind:int,item:binary,share:double>>"


def _reference(entries: list[tuple[int, bytes, float]]) -> Reference:
    classes, common = np.zeros(N_CLASSES), sorted((item, share) for kind, item, share in entries if kind == 1)
    for kind, item, share in entries:
        if kind == 0:
            classes[int(item)] = share
    words = np.array([s for _, s in common] + [max(0.0, 1 - sum(s for _, s in common))])
    return Reference(classes / (classes.sum() or 1), {w: i for i, (w, _) in enumerate(common)}, words / words.sum())


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join with a row per key, broadcast if few, which is counted."""
    return left.join(F.broadcast(right), keys) if right.count() <= BROADCAST_ROWS_MAX else salted_join(left, right, keys, "item")


def _medians(shares: DataFrame, folds: DataFrame) -> DataFrame:
    """(lang, kind, item, share): the median of the folds that have documents. Absent folds are zeros, and so may be shares under
    ``COMMON_SHARE``: they don't change a median of at least that."""
    shares = shares.groupBy("lang", "kind", "item").agg(F.sort_array(F.collect_list("share")).alias("shares"))  # FOLDS values at most
    shares = _meet(shares, folds, ["lang"]).withColumn("lower", F.expr("folds div 2 - (folds - size(shares))"))
    shares = shares.select("lang", "kind", "item", F.when(F.col("lower") >= 0, F.get("shares", F.col("lower").cast("int"))).otherwise(0.0).alias("share"))
    return shares.where((F.col("kind") == 0) | (F.col("share") >= COMMON_SHARE))


def _shares(counts: DataFrame) -> DataFrame:
    """(lang, fold, kind, item, share): all shares of classes, and those of words from ``COMMON_SHARE``."""
    of = counts.where("kind <> 1").groupBy("lang", "fold", F.when(F.col("kind") == 0, 0).otherwise(1).alias("kind")).agg(F.sum("n").alias("of"))
    shares = _meet(counts.where("kind < 2"), of, ["lang", "fold", "kind"]).select("lang", "fold", "kind", "item", (F.col("n") / F.col("of")).alias("share"))
    return shares.where((F.col("kind") == 0) | (F.col("share") >= COMMON_SHARE))


def _measure(docs: DataFrame, text_col: str, lang_col: str) -> tuple[dict[str, Reference], DataFrame | None]:
    """The references that go along with the job, and a table (lang, entries) of all others, None if there are none."""
    lang, text = _inputs(text_col, lang_col)
    counted = map_batches(docs.select(lang.alias("lang"), text.alias("text")), _count, "lang string, fold int, kind int, item binary, n long")
    sums = stored(counted.groupBy("lang", "fold", "kind", "item").agg(F.sum("n").alias("n")), "counts")
    total = sums.where("kind = 2").agg(F.sum("n")).first()[0]
    if not total:
        return {}, None
    shares = stored(_shares(sums), "shares")
    languages = sums.where("kind = 2").groupBy("lang").agg(F.sum("n").alias("words"), F.count("*").alias("folds"))
    languages = stored(languages.where((F.col("words") >= REFERENCE_WORDS) & (F.col("folds") >= REFERENCE_FOLDS) & (F.col("lang") != "")), "languages")
    # a word common in a fold of all documents is common there in some language
    common = shares.where("kind = 1").select("kind", "item").distinct().unionByName(sums.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(i).alias("item")) for k, i in [(2, b""), *[(0, b"%d" % c) for c in range(N_CLASSES)]]])).alias("x")).select("x.*"))
    whole = _meet(sums, stored(common, "common"), ["kind", "item"]).groupBy("fold", "kind", "item").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(ALL))
    whole = stored(whole, "whole")
    all_folds = whole.where("kind = 2").groupBy("lang").agg(F.count("*").alias("folds"))
    named = stored(_medians(shares, languages), "references")
    large = languages.where(F.col("words") >= LANGUAGE_SHARE * total).select("lang")  # at most 1 / LANGUAGE_SHARE languages
    by_lang: dict[str, list[tuple[int, bytes, float]]] = {}
    for r in named.join(F.broadcast(large), "lang").unionByName(_medians(_shares(whole), all_folds)).collect():
        by_lang.setdefault(r.lang, []).append((r.kind, bytes(r.item), r.share))
    shipped = {name: _reference(entries) for name, entries in by_lang.items()}
    rest = languages.where(F.col("words") < LANGUAGE_SHARE * total).select("lang")
    if rest.isEmpty():
        return shipped, None
    entries = _meet(named, rest, ["lang"]).groupBy("lang").agg(F.collect_list(F.struct("kind", "item", "share")).cast(_ENTRY).alias("entries"))
    return shipped, stored(entries, "rare-references")  # as many entries a language as COMMON_SHARE allows


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, Reference]:
    """References of the languages with ``LANGUAGE_SHARE`` of all words, and of all documents under ``ALL``, from every row of ``docs``."""
    return _measure(docs, text_col, lang_col)[0]


def _inputs(text_col: str, lang_col: str) -> tuple[Column, Column]:
    """Language and text in UTF-8, null as empty."""
    return F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")


def verdict(text: bytes, lang: str, refs: dict[str, Reference], own: Reference | None = None) -> tuple[tuple[int, int, int, int, int], bool, float | None, float | None, bool]:
    """The five base figures, base_failed, the two distances (null if not judged), kept. ``own``: the language's reference if not in ``refs``."""
    figures = base(text)
    failed = figures[0] < LEAST_WORDS or 100 * figures[4] > REPEAT_PERCENT * figures[0]
    own = own or refs.get(lang)
    if figures[0] < MIN_WORDS or own is None:
        return figures, failed, None, None, not failed
    wide, near, by_class, by_word = figures[0] ** -0.5, False, None, None
    for ref in (own, refs[ALL]):  # a wrong language mark alone is no fault
        if not near:
            by_class, by_word = ref.distances(text, text.split())
            near = by_class <= CLASS_LIMIT + CLASS_WIDER * wide and by_word <= WORD_LIMIT + WORD_WIDER * wide
    return figures, failed, by_class, by_word, near and not failed


def _judged(source: DataFrame, refs: tuple[dict[str, Reference], DataFrame | None], run: Callable, schema) -> DataFrame:
    """``run`` on the batches of ``source``, whose last columns are language and text; a third gives the entries of a language's
    reference if it doesn't go along with the job. Then only rows of such languages move, split by text."""
    lang, text = source.columns[-2:]
    (own,) = fresh(source, "entries")
    direct = source.withColumn(own, F.lit(None).cast(_ENTRY))
    shipped, rare = refs
    if rare is not None:
        here = F.col(f"`{lang}`").isin("", *[name for name in shipped if name != ALL])
        found = salted_join(source.where(~here), rare.toDF(lang, own), [lang], text, "left")
        direct = direct.where(here).unionByName(found.select(*[F.col(f"`{c}`") for c in direct.columns]))
    return map_batches(direct, run, schema)


def _verdicts(batch: pa.RecordBatch, refs: dict[str, Reference]) -> Iterator[tuple]:
    """Verdicts of a batch from ``_judged``."""
    last, own = None, None
    for k, (lang, text) in enumerate(zip(*batch.columns[-3:-1], strict=True)):
        lang = lang.as_py()
        if lang != last:
            entries = batch.column(batch.num_columns - 1)[k].as_py()
            last, own = lang, entries and _reference([(e["kind"], e["item"], e["share"]) for e in entries])
        yield verdict(text.as_py(), lang, refs, own)


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance, word_distance."""
    refs = _measure(docs, text_col, lang_col)
    shipped = refs[0]
    lang, text = _inputs(text_col, lang_col)
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), lang.alias("lang"), text.alias("text"))
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = source.select("doc_id").schema
    for name in figures:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("kept", "boolean").add("class_distance", "double").add("word_distance", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("quality")
        for batch in batches:
            rows = list(_verdicts(batch, shipped))
            columns = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(5)]
            columns += [pa.array([r[k] for r in rows], kind) for k, kind in ((1, pa.bool_()), (4, pa.bool_()), (2, pa.float64()), (3, pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return _judged(source, refs, run, schema)


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; rows of languages whose reference goes along never move."""
    refs = _measure(docs, text_col, lang_col)
    source = docs.withColumns(dict(zip(fresh(docs, "lang", "text"), _inputs(text_col, lang_col), strict=True)))
    return _judged(source, refs, _filter(refs[0]), docs.schema)


def _filter(refs: dict[str, Reference]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("quality")
        for batch in batches:
            mask = pa.array([v[-1] for v in _verdicts(batch, refs)], pa.bool_())
            yield batch.select(range(batch.num_columns - 3)).filter(mask)

    return run

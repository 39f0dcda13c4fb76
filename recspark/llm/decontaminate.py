"""Benchmark decontamination by templates (operator 3).

Texts become templates: numbers, units after numbers and names are typed
placeholders, other words are lower-case literals.  Windows of ``window``
template tokens are hash-joined with the windows of the benchmark items; hits
are gathered per document, item and band of neighbouring diagonals.  A slot
check then looks for the longest chain of diagonals of the band on which each
benchmark value maps to one document value throughout (renamed, but
consistently), which tells a re-parameterised question from texts that only
share phrases; hits beside the chain count for nothing.  A document is
contaminated by an item when the consistent windows cover at least
``min_coverage`` of the windows that the item emits.

A capitalised word at the start of a sentence or line is a literal, but windows
with such words are also taken with these as names, so that a question whose
names stand at sentence starts is found when they are changed.  Starts that do
not map consistently count for nothing; they veto no other hit.

Windows need ``min_literals`` literal words (one less where sentence starts are
names), so runs of placeholders match
nothing.  Windows with names are also compared with the names as plain words:
a lower-cased copy of an item still matches.  Items that emit fewer than
``FEW`` windows (short ones, or mostly numbers) are also looked for as a whole:
all their template tokens in a row, with consistent slots, or with unchanged
ones if the whole item has fewer than ``min_literals`` literal words.

Defined cases: null and empty texts match nothing; documents with equal id and
text share their result; repeated items are matched each; either table may be
empty; columns other than id and text are ignored (``clean_stage`` keeps them).
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import _MIX_A, BATCH_ROWS, chunks, saved, scramble, table, window_codes

WINDOW = 8
MIN_LITERALS = 5
MIN_COVERAGE = 0.5
#: Benchmark windows that are sent to the workers for a first look; more go through a shuffled join.
MAX_SENT_WINDOWS = 2_000_000
BAND = 16
#: Characters of the texts that are cut into templates at a time.
BATCH_CHARS = 1_000_000
#: Items that emit fewer windows are also matched as one window of their whole template.
FEW = 4

#: Number words and units (fixed values).
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
    "million billion half dozen".split())
UNITS = frozenset(
    "% percent mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms "
    "ounce ounces pound pounds lb lbs ton tons ml l liter liters litre litres gallon gallons second seconds s "
    "minute minutes min hour hours h day days week weeks month months year years dollar dollars cent cents euro "
    "euros $ € £ mph kmh degree degrees meter meters metre metres kilometer kilometers".split())

_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*")
_NUMBER_UNIT = re.compile(r"([+-]?[$€£]?\d[\d.,]*)([^\W\d_]{1,3}|%)$")
_EDGE = "\"'`.,;:!?()[]{}<>*_~#|&-–—“”‘’«»…"
_SENTENCE_END = (".", "!", "?", ":", ";")

NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
#: Forms of a window: names as placeholders, names as plain words, capitalised sentence starts as names too.
TYPED, BARE, OPEN = 0, 1, 2


class Words(dict):
    """Ids of raw words, and what each becomes, worked out once for each word a worker has met.

    ``of`` empties the memo between texts when it holds ``limit`` words, so that a worker's
    memory does not grow with the corpus; results do not depend on the memo.
    """

    _EMPTY, _DOUBLE, _NUM, _UNIT, _CAP, _ENDS = (1 << k for k in range(6))

    def __init__(self, limit: int = 400_000):
        super().__init__()
        import xxhash
        self._hash = xxhash.xxh3_64_intdigest
        self._limit = limit
        self._fresh()

    def _fresh(self):
        self.clear()
        self.plain, self._parts = [], {}
        self._code, self._flags = np.empty(1024, np.uint64), np.empty(1024, np.uint8)
        self._typed = np.array([0] + [self._digest(t) for t in (NUM, UNIT, NAME)], np.uint64)

    def _digest(self, word: str) -> int:
        return self._hash(word.encode("utf-8", "surrogatepass"))

    def _add(self, plain: str, flags: int) -> int:
        i = len(self.plain)
        if i == len(self._code):
            self._code, self._flags = (np.concatenate([x, np.empty_like(x)]) for x in (self._code, self._flags))
        self._code[i], self._flags[i] = self._digest(plain), flags
        self.plain.append(plain)
        return i

    def __missing__(self, raw: str) -> int:
        word = raw.strip(_EDGE)
        low = word.lower()
        ends = self._ENDS if raw.rstrip("\"')”’»").endswith(_SENTENCE_END) else 0
        both = None
        if not low:
            kind = self._EMPTY
        elif (word[0].isdigit() or (len(word) > 1 and word[0] in "+-$€£")) and (
                (both := _NUMBER_UNIT.match(word)) and both.group(2).lower() in UNITS):
            kind = self._DOUBLE
        elif low in NUMBER_WORDS or (
                (word[0].isdigit() or (len(word) > 1 and word[0] in "+-$€£")) and _NUMBER.fullmatch(word)):
            kind = self._NUM
        else:
            kind = (self._UNIT if low in UNITS else 0) | (
                self._CAP if word[0].isupper() and len(word) > 1 and word[1:].islower() else 0)
        self[raw] = i = self._add(low, kind | ends)
        if kind == self._DOUBLE:
            self._parts[i] = self._add(both.group(1), self._NUM), self._add(both.group(2).lower(), self._UNIT)
        return i

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the template tokens of some texts, one text after another, the tokens' kinds, and their texts' numbers.

        Kinds: 0 literal, 1 number, 2 unit, 3 name, 4 literal that may be a name (a capitalised
        word at the start of a sentence or line).
        """
        if len(self) >= self._limit:
            self._fresh()
        lines, n_lines = [], []
        for text in texts:
            own = text.split("\n")
            n_lines.append(len(own))
            lines += map(str.split, own)
        size = np.fromiter(map(len, lines), np.int64, len(lines))
        owner = np.repeat(np.repeat(np.arange(len(texts)), n_lines), size)
        ids = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(lines)), np.int64, int(size.sum()))
        flags = self._flags[ids]
        begins = np.zeros(len(ids) + 1, bool)
        begins[1:] = flags & self._ENDS
        begins[np.cumsum(size) - size] = True
        begins = begins[:-1]
        lines = None
        if (flags & (self._EMPTY | self._DOUBLE)).any():
            count = np.where(flags & self._EMPTY, 0, np.where(flags & self._DOUBLE, 2, 1))
            ends = np.cumsum(count)
            first = (ends - count)[(flags & self._DOUBLE) > 0]
            halves = np.array([self._parts[i] for i in ids[(flags & self._DOUBLE) > 0].tolist()], np.int64).reshape(-1, 2)
            ids, begins, owner = (np.repeat(x, count) for x in (ids, begins, owner))
            ids[first], ids[first + 1] = halves[:, 0], halves[:, 1]
            flags = self._flags[ids]
        number = (flags & self._NUM) > 0
        after = np.zeros(len(ids), bool)
        after[1:] = number[:-1] & (owner[1:] == owner[:-1])
        kind = np.where((flags & self._CAP) > 0, np.where(begins, 4, 3), 0)
        kind = np.where(number, 1, np.where(((flags & self._UNIT) > 0) & after, 2, kind)).astype(np.int8)
        return ids, kind, owner

    def codes(self, ids: np.ndarray, kind: np.ndarray) -> dict[int, np.ndarray]:
        """Codes of the tokens by form: ``TYPED``; ``BARE`` and ``OPEN`` only where they differ from it."""
        typed = self._code[ids]
        plain, named = typed, kind == 3
        slots = (kind > 0) & (kind < 4)
        typed = np.where(slots, self._typed[np.where(slots, kind, 0)], typed)
        forms = {TYPED: typed}
        if named.any():
            forms[BARE] = np.where(named, plain, typed)
        if (kind == 4).any():
            forms[OPEN] = np.where(kind == 4, self._typed[3], typed)
        return forms


def template(text: str) -> tuple[list[str], list[str], list[int]]:
    """Template tokens, their plain words, and their kinds (see ``Words.of``)."""
    words = Words()
    ids, kind, _ = words.of([text])
    plain, kinds = [words.plain[i] for i in ids.tolist()], kind.tolist()
    typed = {1: NUM, 2: UNIT, 3: NAME}
    return [typed.get(k, p) for k, p in zip(kinds, plain)], plain, kinds


def _windows(forms: dict, kind, owner, window: int, min_literals: int):
    """(place, code, form) of the windows within one text with enough literals."""
    n = len(kind) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int8)
    within = owner[window - 1:] == owner[:n]

    def holding(which):
        total = np.concatenate([[0], np.cumsum(which)])
        return total[window:] - total[:-window]
    free, found = holding((kind == 0) | (kind == 4)), []
    for form, codes in forms.items():
        if form == TYPED:
            want = free >= min_literals
        elif form == BARE:                                            # names count as literals
            named = holding(kind == 3)
            want = (named > 0) & (free + named >= min_literals)
        else:                                                         # one of the starts may stand for a literal
            starts = holding(kind == 4)
            want = (starts > 0) & (free - starts >= min_literals - 1)
        at = np.flatnonzero(want & within)
        found.append((at, window_codes(codes, window)[at], np.full(len(at), form, np.int8)))
    return tuple(np.concatenate(x) for x in zip(*found))


#: Kinds of tokens that are slots, by form.
_SLOT_KINDS = {TYPED: (1, 2, 3), BARE: (1, 2), OPEN: (1, 2, 3, 4)}


def _slots_of(plain: list[str], ids: np.ndarray, kind: np.ndarray, at: int, size: int, form: int) -> list[str]:
    return [plain[i] for i, k in zip(ids[at:at + size].tolist(), kind[at:at + size].tolist()) if k in _SLOT_KINDS[form]]


def _within(sorted_codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return sorted_codes[np.minimum(np.searchsorted(sorted_codes, code), len(sorted_codes) - 1)] == code


_SLOTS = pa.list_(pa.string())
_INT = pa.int32()
#: What a text emits, after its id and mark; ``length`` is 0 for windows, else that of the whole template.
WINDOW_ROW = StructType([StructField(c, t) for c, t in (
    ("place", IntegerType()), ("length", IntegerType()), ("form", IntegerType()), ("code", LongType()),
    ("slots", ArrayType(StringType())))])
_ARROW = [_INT, _INT, _INT, pa.int64(), _SLOTS]
#: What a benchmark item emits beside: numbers of windows, typed and in all, and literals of the whole.
ITEM_ROW = StructType([StructField(c, IntegerType()) for c in ("n_typed", "n_windows", "literals")])


def _emit(ids, marks, take, columns, types, names):
    where = pa.array(take, pa.int64())
    return pa.RecordBatch.from_arrays([ids.take(where), marks.take(where)] + [
        pa.array(c, t) for c, t in zip(columns, types)], names=["id", "mark", *names])


def _item_fn(window: int, min_literals: int):
    def cut(batches):
        words = Words()
        for batch in batches:
            ids, texts, marks = batch.column(0), batch.column(1), batch.column(2)
            for rows in chunks(range(batch.num_rows), BATCH_ROWS):
                take, out = [], []
                for i in rows:
                    own, kind, owner = words.of([texts[i].as_py() or ""])
                    forms, n = words.codes(own, kind), len(own)
                    at, code, form = _windows(forms, kind, owner, window, min_literals)
                    few = typed = int((form == TYPED).sum())
                    every = len(set(at.tolist()))
                    if typed < FEW:                                   # windows alone prove little
                        typed = max(n - window + 1, 1)
                    if every < FEW:
                        every = max(n - window + 1, 1)
                    tail = (typed, every, int(((kind == 0) | (kind == 4)).sum()))
                    emitted = [(p, 0, f, c, _slots_of(words.plain, own, kind, p, window, f), *tail) for p, c, f in zip(
                        at.tolist(), code.view(np.int64).tolist(), form.tolist())]
                    if n and few < FEW:
                        emitted += [(0, n, f, int(window_codes(x, n).view(np.int64)[0]),
                                     _slots_of(words.plain, own, kind, 0, n, f), *tail) for f, x in forms.items()]
                    take += [i] * len(emitted)
                    out += emitted
                if take:
                    yield _emit(ids, marks, take, zip(*out), _ARROW + [_INT] * 3, WINDOW_ROW.names + ITEM_ROW.names)
    return cut


def _text_fn(window: int, min_literals: int, sent, wholes):
    def cut(batches):
        words = Words()
        known = None if sent is None else sent.value
        for batch in batches:
            ids, texts, marks = batch.column(0), batch.column(1), batch.column(2)
            for rows, some in _together(texts):
                take, out = [], []
                own, kind, owner = words.of(some)
                forms = words.codes(own, kind)
                found = [(0, window, *_windows(forms, kind, owner, window, min_literals), known)]
                for size, of_size in wholes.value.items():
                    if len(own) >= size:
                        at = np.flatnonzero(owner[size - 1:] == owner[:len(owner) - size + 1])
                        found += [(size, size, at, long_codes(x, size)[at], np.full(len(at), form), of_size)
                                  for form, x in forms.items()]
                first = np.searchsorted(owner, np.arange(len(some)))
                for length, size, at, code, form, only in found:
                    if only is not None:
                        hit = np.flatnonzero(_within(only, code))
                        at, code, form = at[hit], code[hit], form[hit]
                    for p, t, c, f in zip(at.tolist(), owner[at].tolist(), code.view(np.int64).tolist(), form.tolist()):
                        take.append(rows[t])
                        out.append((p - int(first[t]), length, f, c, _slots_of(words.plain, own, kind, p, size, f)))
                if take:
                    yield _emit(ids, marks, take, zip(*out), _ARROW, WINDOW_ROW.names)
    return cut


def _together(texts: pa.Array):
    """Runs of rows (numbers, texts) of at most ``BATCH_ROWS`` rows and, but for single rows, ``BATCH_CHARS`` characters."""
    rows, some, size = [], [], 0
    for i in range(len(texts)):
        text = texts[i].as_py() or ""
        if rows and (size + len(text) > BATCH_CHARS or len(rows) == BATCH_ROWS):
            yield rows, some
            rows, some, size = [], [], 0
        rows.append(i)
        some.append(text)
        size += len(text)
    if rows:
        yield rows, some


def long_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """``window_codes`` by running sums: the time does not grow with the width."""
    powers = np.empty(len(codes) + 1, dtype=np.uint64)
    powers[0], powers[1:] = 1, _MIX_A
    powers = np.multiply.accumulate(powers)
    # the polynomial read from the right end: codes[k] has the weight A ** (len - 1 - k)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers[:-1][::-1], dtype=np.uint64)])
    inverse = np.full(len(codes) + 1, pow(int(_MIX_A), -1, 1 << 64), dtype=np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    n = len(codes) - width + 1
    return scramble((sums[width:] - sums[:n]) * inverse[len(codes) - width - np.arange(n)])


def _emitted(df: DataFrame, id_col: str, text_col: str, fn, more: list) -> DataFrame:
    schema = StructType([StructField("id", df.schema[id_col].dataType), StructField("mark", LongType()),
                         *WINDOW_ROW.fields, *more])
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     F.xxhash64(text_col).alias("mark")).mapInArrow(fn, schema)


def _sorted_codes(rows: list) -> np.ndarray:
    return np.sort(np.array(rows or [0], dtype=np.int64).view(np.uint64))


CHAIN = StructType([StructField(c, IntegerType()) for c in (
    "item_typed", "item_windows", "doc_start", "doc_end", "n_matched", "n_typed", "n_slots", "n_changed")])


def _mapping(hits: list) -> dict | None:
    """Document value of each benchmark value in hits (item_place, was, now); None if one has two."""
    out: dict = {}
    for hit in hits:
        for was, now in zip(hit["was"], hit["now"]):
            if out.setdefault(was, now) != now:
                return None
    return out


def _readings(hits: list) -> list[list]:
    """All hits, and those without sentence starts as names: these starts must not veto the others."""
    strict = [h for h in hits if h["form"] != OPEN]
    return [hits] if len(strict) == len(hits) else [hits, strict] if strict else [hits]


def chain(diagonals: list, window: int = WINDOW) -> tuple[int, int, int, int, int, int] | None:
    """Place, end, matched windows, typed ones of these, slots and changed slots of a band's best consistent chain.

    A chain starts with the hits of one diagonal; each other diagonal, the most
    hits first, adds its hits at places that are still open, if all slots stay
    consistent with these.  Other hits (a template that repeats within the band
    hits itself at each period) do not count and veto nothing.  None: there is
    no consistent diagonal.
    """
    order = sorted(((d["diagonal"], _readings(d["hits"])) for d in diagonals),
                   key=lambda d: (-len({h["item_place"] for h in d[1][0]}), d[0]))
    best = None
    for begin, readings in order:
        start = next(((hits, own) for hits in readings if (own := _mapping(hits)) is not None), None)
        if start is None:
            continue
        used, values = list(start[0]), dict(start[1])
        placed = {h["item_place"]: begin for h in used}
        for diagonal, readings in order:
            for hits in readings:
                new = [h for h in hits if h["item_place"] not in placed]
                own = _mapping(new) if new else None
                if own is not None and all(values.get(k, v) == v for k, v in own.items()):
                    values |= own
                    placed |= {h["item_place"]: diagonal for h in new}
                    used += new
                    break
        changed = sum(k != v for k, v in values.items())
        at = [p + d for p, d in placed.items()]
        rank = (len(placed), -changed, -min(at), -max(at))
        if best is None or rank > best[0]:
            typed = len({h["item_place"] for h in used if h["form"] != BARE})
            best = rank, (min(at), max(at) + window, len(placed), typed, len(values), changed)
    return best and best[1]


def _chain_fn(window: int):
    def cut(batches):
        for batch in batches:
            for rows in chunks(range(batch.num_rows), BATCH_ROWS):
                got = [(i, chain(batch.column("diagonals")[i].as_py(), window)) for i in rows]
                got = [(i, *x) for i, x in got if x is not None]
                if got:
                    take, *columns = zip(*got)
                    part = batch.drop_columns(["diagonals"]).take(pa.array(take, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        part.columns + [pa.array(c, pa.int32()) for c in columns],
                        names=part.schema.names + CHAIN.names[2:])
    return cut


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_literals: int = MIN_LITERALS,
                 min_coverage: float = MIN_COVERAGE, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row a (document, item): place, matched windows, coverage, and what became of the slots."""
    spark = docs.sparkSession
    items = saved(_emitted(benchmark, item_col, item_text_col, _item_fn(window, min_literals), ITEM_ROW.fields),
                  "bench-windows")
    distinct = items.where("length = 0").select("code").distinct()
    sent = None
    if distinct.limit(MAX_SENT_WINDOWS + 1).count() <= MAX_SENT_WINDOWS:   # a proven bound before it is sent
        sent = spark.sparkContext.broadcast(_sorted_codes([r[0] for r in distinct.collect()]))
    whole = items.where("length > 0").select("length", "code").distinct()
    if whole.limit(MAX_SENT_WINDOWS + 1).count() <= MAX_SENT_WINDOWS:
        of_length: dict = {}
        for r in whole.collect():
            of_length.setdefault(r.length, []).append(r.code)
        wholes = {n: _sorted_codes(c) for n, c in of_length.items()}
    else:                                                             # their lengths are few; codes go through the join
        wholes = {r.length: None for r in whole.select("length").distinct().collect()}
    wholes = spark.sparkContext.broadcast(wholes)
    texts = _emitted(docs, id_col, text_col, _text_fn(window, min_literals, sent, wholes), [])
    item = items.select("code", "length", F.col("id").alias("item"), F.col("mark").alias("item_mark"),
                        F.col("place").alias("item_place"), F.col("n_typed").alias("item_typed"),
                        F.col("n_windows").alias("item_windows"), F.col("slots").alias("item_slots"),
                        F.col("form").alias("item_form"), "literals")
    key = ["id", "mark", "item", "item_mark"]
    joined = texts.join(item, ["code", "length"]).where(F.size("slots") == F.size("item_slots"))
    struct = F.struct("item_place", F.col("item_form").alias("form"), F.col("item_slots").alias("was"), F.col("slots").alias("now"))
    # a whole item is a diagonal of its own
    hits = (joined.groupBy(*key, "length", (F.col("place") - F.col("item_place")).alias("diagonal"))
            .agg(F.max("item_typed").alias("item_typed"), F.max("item_windows").alias("item_windows"),
                 F.max("literals").alias("literals"), F.collect_set(struct).alias("hits")))
    bands = F.array(*[F.struct(F.lit(k).alias("shift"), F.floor((F.col("diagonal") + k * BAND // 2) / BAND).alias("band"))
                      for k in (0, 1)])
    bands = F.when(F.col("length") == 0, bands).otherwise(F.array(F.struct(
        F.lit(2).alias("shift"), F.col("diagonal").cast("long").alias("band"))))
    found = hits.withColumn("b", F.explode(bands)).groupBy(*key, "length", "b").agg(
        F.max("item_typed").alias("item_typed"), F.max("item_windows").alias("item_windows"),
        F.max("literals").alias("literals"), F.collect_list(F.struct("diagonal", "hits")).alias("diagonals"))
    places = F.array_distinct(F.flatten(F.transform("diagonals", lambda d: d["hits"]["item_place"])))
    found = found.where((F.col("length") > 0) | (
        F.size(places) >= min_coverage * F.least("item_typed", "item_windows")))
    also = [StructField("length", IntegerType()), StructField("literals", IntegerType())]
    kept = StructType([found.schema[c] for c in key] + also + CHAIN.fields)
    found = found.select(*key, "length", "literals", "item_typed", "item_windows", "diagonals").mapInArrow(
        _chain_fn(window), kept)
    is_whole = F.col("length") > 0
    share = F.least(F.lit(1.0), F.greatest(F.col("n_typed") / F.col("item_typed"), F.col("n_matched") / F.col("item_windows")))
    found = found.withColumns({
        "coverage": F.when(is_whole, 1.0).otherwise(share),
        "doc_end": F.when(is_whole, F.col("doc_start") + F.col("length")).otherwise(F.col("doc_end")),
        "n_matched": F.when(is_whole, F.col("item_windows")).otherwise(F.col("n_matched"))})
    found = found.where((F.col("coverage") >= min_coverage) & (
        ~is_whole | (F.col("literals") >= min_literals) | (F.col("n_changed") == 0)))
    best = F.max_by(F.struct("doc_start", "doc_end", "n_matched", "coverage", "n_slots", "n_changed"),
                    F.struct("n_matched", -F.col("n_changed"), -F.col("doc_start"), -F.col("doc_end")))
    return (found.groupBy("id", "mark", "item", "item_mark").agg(best.alias("x"))
            .select(F.col("id").alias(id_col), F.col("mark").alias("text_mark"), F.col("item").alias(item_col), "x.*"))


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item is found in, with their own columns."""
    bad = contaminated(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("doc_id").alias("_id"), "text_mark").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d"))
    same = F.col("_d.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("_d.text") == F.col("text_mark"))
    return rows.join(bad, same, "left_anti").select("_d.*")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in the documents."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_mark")


QUERIES = {"op3_decontamination": op3_decontamination}
SQL: dict = {}

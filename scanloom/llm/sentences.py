"""Sentence boundaries across languages and scripts.

``prose.blocks`` finds the stretches of natural language. Statistics of every word with a final period
are gathered over all of them, per language and pooled, and scored by log-likelihood ratios in the
manner of Kiss and Strunk (2006):

* abbreviations: words that keep their period, short and with inner periods by preference;
* collocations: words whose period a number follows, and pairs of a word, a number (ordinals) or an initial
  with the word after its period that occur together more often than their own counts explain;
* sentence starters: words that follow a sentence end more often than chance.

Each period is then classified with these statistics. Marks that are never ambiguous (``!?`` and those
of other scripts) end a sentence with the closing quotes and brackets after them, unless the sentence
goes on after the quotation. Thai, which has no end marks, ends at blanks between two of its words.

Defined results: NULL, empty and blank texts have no sentences; texts are processed whole; repeated
documents each have theirs; the language column may be wrong, NULL or in any case.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .prose import blocks

#: A word or pair enters the model when it has been seen so often. Every task holds about so many of the most
#: frequent entries, whatever the size of the corpus and the number of languages; the rarer ones are joined to
#: the stretches that ask for them.
LEAST_COUNT = 3
MODEL_WORDS = 200_000
#: Seen so often in a language, an entry is judged by that language alone, else by it and all together.
OWN_COUNT = 20
ABBREVIATION_SCORE = 0.3
COLLOCATION_LLR = 7.88
STARTER_LLR = 30.0
#: Share of a word's capitalised continuations that a collocation must have.
MOSTLY = 0.8
#: How many times more often it must follow the word than begin sentences elsewhere.
LIFT = 40
POOLED = "*"

_CLOSERS = "\"'”’»›)]}」』）】〉》”’"
_OPENERS = "\"'“‘„‚«‹([{「『（【〈《¿¡"
_END = re.compile(
    r"(?P<mark>[.!?…;\u037e।॥؟۔。！？｡]+)"
    # closing marks; those that open in some languages and close in others close where nothing follows them directly
    rf"(?P<close>(?:[{re.escape(_CLOSERS)}]|[\u201c\u2018\xab](?=\s|$|[{re.escape(_CLOSERS)}.,;:!?\u201c\u2018]))*"
    rf"(?:\s+[\xbb\u203a](?=\s|$|[.,;:!?]))?[{re.escape(_CLOSERS)}]*)(?P<gap>\s*)"
)
_THAI_BLANK = re.compile(r"(?<=[ก-๛຀-໿])(\s+)(?=[ก-๎຀-໿]|[" + re.escape(_OPENERS) + r"]*[A-ZÀ-ÞА-Я])")
_THAI_END = re.compile(r"[ก-๛຀-໿]")
_GREEK = re.compile(r"[Ͱ-Ͽἀ-῿]")
#: Particles that carry a quotation on when they follow its closing mark at once.
_CARRY_ON = ("と", "って", "라고", "하고", "고 ", "이라고")
_FULL = set("।॥؟۔。！？｡")
_CODE_WORD = re.compile(r"[A-Z]\.?\d")
_CAMEL = re.compile(r"[a-z]{1,3}[A-Z]")
_CASELESS = re.compile(r"[֐-໿က-႟ក-៿぀-ヿ㐀-鿿가-힯豈-﫿]")
_MIXED = re.compile(rf"(?:v\d[\d.]*|[a-z]+){_CASELESS.pattern}")
#: A sentence of a script without case that goes on at once: its opening marks, a version number, its first character.
_STARTS_CASELESS = re.compile(rf"[{re.escape(_OPENERS)}]*(?:v\d[\d.]*)?{_CASELESS.pattern}")


def _next_class(text: str, at: int) -> tuple[str, str]:
    """(class, word) of what follows: ``low``, ``up``, ``num``, ``other`` or ``end``."""
    n = len(text)
    while at < n and (text[at] in _OPENERS or text[at].isspace()):
        at += 1
    if at >= n:
        return "end", ""
    stop = at
    while stop < n and not text[stop].isspace():
        stop += 1
    word = text[at:stop].rstrip(_CLOSERS + ".,;:!?…")
    c = text[at]
    if c.isdigit() or c in "$€£#§" or _CODE_WORD.match(word):
        return "num", word
    if c.islower():
        return ("other" if _MIXED.match(word) else "up" if _CAMEL.match(word) else "low"), word
    if c.isupper() or c.istitle():
        return "up", word
    if c.isalpha():
        return "other", word
    return "low" if c in ",;:-–—)" else "other", word


def _before(text: str, at: int) -> str:
    """The word that ends at a place, however long."""
    start = at
    while start > 0 and not text[start - 1].isspace():
        start -= 1
    return text[start:at]


def _pairs_up(word: str) -> bool:
    """Words that can belong to the word after their period: numbers, initials and words in lower case.

    A capitalised word may be a sentence of its own, and a name with digits is none that recurs.
    """
    word = word.lstrip(_OPENERS + "-–—/")
    return _type(word) == "##" or len(word) == 1 or word[:1].islower() and not any(c.isdigit() for c in word)


def _type(word: str) -> str:
    """The word before a period, in lower case, numbers made equal."""
    word = word.lstrip(_OPENERS + "-–—/").lower()
    return "##" if word and (word[0].isdigit() or word[0] in "$€£.") and any(c.isdigit() for c in word) and not any(c.isalpha() for c in word) else word


def language(code: str | None) -> str:
    code = (code or "").strip().lower()[:2]
    return code if re.fullmatch("[a-z]{2}", code) else "??"


def _periods(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(start of mark, end of closers, end of gap, mark) of every possible end in a stretch."""
    for m in _END.finditer(text):
        yield m.start(), m.end("close"), m.end(), m["mark"]


def observe(text: str, counts: Counter, lang: str) -> None:
    """Adds what a stretch of natural language tells about its words to ``counts``."""
    for word in text.split():
        bare = word.strip(_CLOSERS + _OPENERS)
        if not bare or not bare[0].isalpha():
            continue
        if bare[-1] != ".":
            counts[lang, "plain", bare.rstrip(",;:!?…").lower()] += 1
        if bare[0].islower():
            counts[lang, "lower", bare.rstrip(".,;:!?…").lower()] += 1
    at = 0
    for a, b, c, mark in _periods(text):
        if mark[0] in _FULL or mark[0] in ";;":
            continue
        kind, nxt = _next_class(text, c)
        nxt_type = "##" if kind == "num" else nxt.lower()
        if c == b and kind != "end":
            continue
        if mark == ".":
            w = _type(_before(text, a))
            if w:
                counts[lang, "dot", w] += 1
                counts[lang, "dot_" + kind, w] += 1
                if kind == "up" and _pairs_up(_before(text, a)):
                    counts[lang, "pair", f"{w} {nxt_type}"] += 1
                if w == "##" and kind == "up":
                    counts[lang, "after_number", nxt_type] += 1
        if kind == "up":
            counts[lang, "starts", nxt_type] += 1
        at = c
    return


def statistics(pieces: DataFrame) -> DataFrame:
    """(lang, kind, word, n) summed over all stretches; ``*`` is the pool of all languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(counts)
            batch = pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], pa.string()) for i in range(3)] + [pa.array([counts[k] for k in keys], pa.int64())],
                names=["lang", "kind", "word", "n"],
            )
            counts.clear()
            return batch

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                observe(text, counts, lang)
            if len(counts) > 200_000:
                yield out()
        if counts:
            yield out()

    seen = pieces.select("lang", "text").mapInArrow(run, "lang string, kind string, word string, n bigint")
    per = stored(seen.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")), "counts")
    pool = per.groupBy("kind", "word").agg(F.sum("n").alias("n")).select(F.lit(POOLED).alias("lang"), "kind", "word", "n")
    return stored(per.union(pool), "statistics")


def _ll(k, n, p):
    """Log-likelihood of k in n draws at rate p, with rates kept off 0 and 1."""
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return k * F.log(p) + (n - k) * F.log(1 - p)


def _llr(k1, n1, k2, n2):
    """Dunning's ratio, signed: positive where the first rate is the higher one."""
    k1, n1, k2, n2 = (F.col(x).cast("double") if isinstance(x, str) else x.cast("double") for x in (k1, n1, k2, n2))
    p1, p2, p = k1 / F.greatest(n1, F.lit(1.0)), k2 / F.greatest(n2, F.lit(1.0)), (k1 + k2) / F.greatest(n1 + n2, F.lit(1.0))
    ratio = 2 * (_ll(k1, n1, p1) + _ll(k2, n2, p2) - _ll(k1, n1, p) - _ll(k2, n2, p))
    return F.when(p1 >= p2, ratio).otherwise(-ratio)


KINDS = ("plain", "lower", "dot", "dot_low", "dot_num", "dot_up", "dot_other", "dot_end", "starts", "after_number")


def _collocations(stats: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, word, dot, pair): the pairs "word next" with a period between, and whether they belong together; dot is how often.

    The next word must follow this one's period more often than it begins sentences elsewhere, by the ratio's
    threshold. After a word it must also be what nearly always follows, and follow it by far more often; after a number or an initial, which
    many words follow, it must be no word that often begins sentences.
    """
    pairs = stats.where(F.col("kind") == "pair").where(F.col("n") >= LEAST_COUNT).select("lang", F.col("word").alias("pair"), F.col("n").alias("k"))
    pairs = pairs.withColumns({"word": F.split_part("pair", F.lit(" "), F.lit(1)), "next": F.split_part("pair", F.lit(" "), F.lit(2))})
    first = words.select("lang", "word", F.col("dot_up").alias("n1"), "all_starts")
    second = words.select("lang", F.col("word").alias("next"), F.col("starts").alias("n2"), F.col("starter").alias("next_starts"))
    known = pairs.join(first, ["lang", "word"]).join(second, ["lang", "next"])
    elsewhere, others = F.greatest(F.col("n2") - F.col("k"), F.lit(0)), F.greatest(F.col("all_starts") - F.col("n1"), F.lit(1))
    together = _llr("k", "n1", elsewhere, others) > COLLOCATION_LLR
    free = (F.col("word") == "##") | (F.length("word") == 1)
    usual = F.when(free, ~F.col("next_starts")).otherwise((F.col("k") >= F.col("n1") * MOSTLY) & (F.col("k") / F.col("n1") >= LIFT * elsewhere / others))
    judged = known.select("lang", F.col("pair").alias("word"), F.col("k").alias("dot"), (together & usual).alias("pair"))
    return judged.where(F.col("pair") | (F.col("dot") >= OWN_COUNT))


def model_table(stats: DataFrame) -> DataFrame:
    """(lang, word, dot, starts, abbreviation, before_number, starter, after_number, lower, pair): the scored words, and pairs."""
    wide = stats.where(F.col("kind") != "pair").groupBy("lang", "word").pivot("kind", list(KINDS)).agg(F.sum("n")).na.fill(0)
    wide = stored(wide, "words")
    total = stored(wide.groupBy("lang").agg(*[F.sum(k).alias("all_" + k) for k in ("plain", "dot", "dot_num", "dot_low", "starts", "after_number")]), "totals")
    w = wide.join(total, "lang")  # a row per language
    n = F.col("plain") + F.col("dot")
    tokens = F.col("all_plain") + F.col("all_dot")
    # the ratio of "keeps its period nearly always" to "has one as often as any word"
    dot = F.col("dot").cast("double")
    ratio = -2 * (_ll(dot, n, F.col("all_dot") / tokens) - _ll(dot, n, F.lit(0.99)))
    inner = F.length(F.regexp_replace("word", r"[^.]", ""))
    letters = F.length(F.regexp_replace("word", r"\.", ""))
    abbreviation = ratio * F.exp(-letters.cast("double")) * (inner + 1) * F.pow(F.greatest(letters, F.lit(1)).cast("double"), -F.col("plain").cast("double"))
    bound = F.col("dot_num") + F.col("dot_up") + F.col("dot_other") + F.col("dot_end")
    attracts = (F.col("dot_num") * 2 > bound) & (_llr("dot_num", bound, F.col("all_dot_num") - F.col("dot_num"), F.col("all_dot") - F.col("all_dot_low") - bound) > COLLOCATION_LLR)
    starter = _llr("starts", n + F.col("starts"), F.col("all_starts") - F.col("starts"), tokens) > STARTER_LLR
    ordinal = (F.col("after_number") > 0) & (_llr("after_number", n, F.col("all_after_number") - F.col("after_number"), tokens) > COLLOCATION_LLR) & (F.col("after_number") * 2 > F.col("starts"))
    w = w.withColumns({"abbreviation": abbreviation > ABBREVIATION_SCORE, "before_number": attracts, "starter": starter, "ordinal": ordinal})
    kept = w.where((F.col("dot") >= LEAST_COUNT) | (F.col("starts") >= LEAST_COUNT)).select(
        "lang", "word", "dot", "starts", "abbreviation", "before_number", "starter", F.col("ordinal").alias("after_number"), (F.col("lower") > 0).alias("lower"), F.lit(False).alias("pair"),
    )
    no = F.lit(False)
    pairs = _collocations(stats, w).select("lang", "word", "dot", F.lit(0).cast("bigint").alias("starts"), no, no, no, no, no, "pair")
    return kept.union(pairs)


def common_entries(scored: DataFrame) -> DataFrame:
    """``scored`` with ``common``: the most frequent entries, about ``MODEL_WORDS`` of them over all languages."""
    seen = F.greatest("dot", "starts")
    scale = F.floor(F.log2(seen.cast("double"))).cast("int")
    sizes = {r["scale"]: r["n"] for r in scored.groupBy(scale.alias("scale")).agg(F.count(F.lit(1)).alias("n")).collect()}  # 63 at most
    room, least = MODEL_WORDS, 64
    for k in sorted(sizes, reverse=True):
        room -= sizes[k]
        if room < 0:
            break
        least = k
    return scored.withColumn("common", scale >= least)


_SCORES = ("dot", "starts", "abbreviation", "before_number", "starter", "after_number", "lower", "pair")


class Model:
    """The learned words, by language with the pool behind it; ``rare`` are those of the stretch at hand."""

    def __init__(self, rows: list):
        self.words = self._by_language(rows)
        self.rare: dict[str, dict[str, tuple]] = {}

    @staticmethod
    def _by_language(rows: list) -> dict[str, dict[str, tuple]]:
        words: dict[str, dict[str, tuple]] = {}
        for r in rows:
            words.setdefault(r["lang"], {})[r["word"]] = tuple(r[k] for k in _SCORES)
        return words

    def at(self, rows: list | None) -> Model:
        """The model for a stretch that these rare words are joined to."""
        self.rare = self._by_language(rows) if rows else {}
        return self

    def _row(self, lang: str, word: str) -> tuple | None:
        return self.words.get(lang, {}).get(word) or self.rare.get(lang, {}).get(word)

    def _get(self, lang: str, word: str, count: int, flag: int) -> bool:
        own = self._row(lang, word)
        if own is not None and own[count] >= OWN_COUNT:
            return own[flag]
        pooled = self._row(POOLED, word)
        return bool(own and own[flag]) or bool(pooled and pooled[flag])

    def abbreviation(self, lang: str, word: str) -> bool:
        return (len(word) == 1 and word.isalpha()) or self._get(lang, word, 0, 2)

    def before_number(self, lang: str, word: str) -> bool:
        return self._get(lang, word, 0, 3)

    def starts(self, lang: str, word: str) -> bool:
        word = word.lower()
        return self._get(lang, word, 1, 4) or (self._get(lang, word, 1, 6) and not self._get(lang, word, 1, 5))

    def together(self, lang: str, before: str, word: str) -> bool:
        return self._get(lang, f"{before} {word.lower()}", 0, 7)

    def ordinal(self, lang: str, word: str) -> bool:
        return self._get(lang, word.lower(), 1, 5)


class _Asked(Model):
    """Notes the words that decisions ask for and the common words lack.

    Every answer is yes: then a decision asks for all the words it may need.
    """

    def __init__(self, words: dict[str, dict[str, tuple]]):
        super().__init__([])
        self.words, self.asked = words, set()

    def _get(self, lang: str, word: str, count: int, flag: int) -> bool:
        self.asked.update((x, word) for x in (lang, POOLED) if word not in self.words.get(x, {}))
        return True


def _ends(text: str, a: int, b: int, c: int, mark: str, lang: str, model: Model) -> bool:
    """Whether the mark at a (closers to b, blanks to c) ends a sentence."""
    closed, gap = b > a + len(mark), c > b
    if c >= len(text):
        return True
    first = mark[0]
    if first in _FULL:
        if closed and not gap and text.startswith(_CARRY_ON, c):
            return False
        if first in "؟۔" or gap or not closed:
            return True
        return not text[c].islower()
    kind, word = _next_class(text, c)
    if first in ";;":
        return bool(_GREEK.match(text[a - 1 : a])) and gap and kind in ("up", "num", "other", "end")
    if not gap:
        # a period inside a token, or a script without blanks goes on right after it
        if "…" in mark or len(mark) > 1 and set(mark) == {"."}:
            return False
        if text[a - 1 : a].isdigit() and first == "." or closed and text.startswith(_CARRY_ON, c):
            return False
        return bool(_STARTS_CASELESS.match(text, c))
    if kind == "low":
        return False
    if kind == "end":
        return True
    if mark != ".":
        return True
    before = _type(_before(text, a))
    if not before:
        return True
    if closed:
        return True
    if kind == "num":
        return not model.before_number(lang, before)
    if kind == "other":
        return True
    if before == "##":
        return not (model.ordinal(lang, word) or model.together(lang, before, word))
    if not model.abbreviation(lang, before):
        return True
    return model.starts(lang, word) and not (_pairs_up(_before(text, a)) and model.together(lang, before, word))


def split(text: str, lang: str, model: Model) -> Iterator[tuple[int, int]]:
    """(start, end) of the sentences of one stretch."""
    cuts = [b for a, b, c, mark in _periods(text) if _ends(text, a, b, c, mark, lang, model)]
    if _THAI_END.search(text):
        cuts = sorted({*cuts, *(m.start() for m in _THAI_BLANK.finditer(text))})
    at, n = 0, len(text)
    for stop in [*cuts, n]:
        while at < stop and text[at].isspace():
            at += 1
        end = stop
        while end > at and text[end - 1].isspace():
            end -= 1
        if end > at and any(ch.isalpha() for ch in text[at:end]):
            yield at, end
        at = max(at, stop)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang, start, text): the stretches of natural language of every document."""
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, lang string, start bigint, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, starts, texts = [], [], [], []
            for i, (lang, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                code = language(lang)
                for start, piece in blocks(text):
                    ids.append(i), langs.append(code), starts.append(start), texts.append(piece)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int32())), pa.array(langs, pa.string()), pa.array(starts, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "lang", "start", "text"],
            )

    return docs.select(id_col, lang_col, text_col).mapInArrow(run, schema)


def rare_words(found: DataFrame, model: Model, rare: DataFrame) -> DataFrame:
    """(piece, rare): the rows of ``rare`` that the decisions in each stretch may need, for stretches that need any."""
    words = model.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, langs, asked = [], [], []
            for i, (lang, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                notes = _Asked(words)
                for period in _periods(text):
                    _ends(text, *period, lang, notes)
                for x, word in notes.asked:
                    at.append(i), langs.append(x), asked.append(word)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(langs, pa.string()), pa.array(asked, pa.string())], names=["piece", "lang", "word"])

    wanted = found.select("piece", "lang", "text").mapInArrow(run, "piece bigint, lang string, word string")
    return wanted.join(rare, ["lang", "word"]).groupBy("piece").agg(F.collect_list(F.struct("lang", "word", *_SCORES)).alias("rare"))


def sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, start_pos, end_pos): code point offsets of every sentence, end exclusive."""
    found = stored(pieces(docs, id_col, text_col, lang_col).withColumn("piece", F.monotonically_increasing_id()), "prose")
    scored = stored(common_entries(stored(model_table(statistics(found)), "scored")), "model")
    model = Model(scored.where("common").collect())
    rare = scored.where("not common")
    if rare.isEmpty():
        found = found.withColumn("rare", F.lit(None))
    else:
        found = found.join(rare_words(found, model, rare), "piece", "left")
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, start_pos bigint, end_pos bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, ends = [], [], []
            for i, (lang, start, text, rows) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)))):
                for a, b in split(text, lang, model.at(rows)):
                    ids.append(i), starts.append(start + a), ends.append(start + b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int32())), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["doc_id", "start_pos", "end_pos"],
            )

    return found.select("doc_id", "lang", "start", "text", "rare").mapInArrow(run, schema)

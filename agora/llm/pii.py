"""PII: base patterns, and terms whose co-occurrence reveals a protected entity.

Every distinct personal datum found by the base patterns (an email, ip, card
or phone number) is a protected entity. Words near its mentions are candidate
terms. With p(e) the share of the corpus' words near e, and p(t), p(t|e) the
shares of t in the corpus and near e,

    PMI(t; e) = log2(p(t|e) / p(t)),   IC(e) = -log2 p(e) >= PMI(t; e),

so PMI / IC is the part of e's information that t discloses: 1 when t occurs
near e only. Terms seen in ``min_contexts`` different contexts of e and at or
above ``generalise_at`` are generalised to their shape, those at or above
``remove_at`` removed, near every mention of e.

DataFrame functions only. Counts cover all documents. What is shuffled: one
row per (task, distinct word), and the few words around personal data. A
frequent entity or term is pre-aggregated and its join salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import durable, id_text, join_to_unique

KINDS = ("email", "ip", "card", "phone", "term")

# The base patterns. Possessive quantifiers and the look-behinds only skip
# starts and retries that cannot match, so that a long run stays linear.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"[\p{L}\p{N}]++"
SALTS = 16


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def find(df: DataFrame, text: str, pattern: str, out: str, only: Column | None = None) -> DataFrame:
    """``df`` with ``out``: array<struct<start, end, value>> of a pattern's matches, in code points.

    The text is split at the matches; a match starts after all gaps and
    matches before it. Prefix sums run over chunks of 64, so many matches in
    one text do not cost their square.
    """
    found, gaps, lens, sums = (f"_{x}_{out}" for x in ("found", "gaps", "lens", "sums"))
    match = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    df = df.withColumn(found, match if only is None else F.when(only, match))
    df = df.withColumn(gaps, F.when(F.size(found) > 0, F.split(F.col(text), pattern, -1)))
    df = df.withColumn(lens, F.when(F.col(gaps).isNotNull(), F.zip_with(
        F.slice(F.col(gaps), F.lit(1), F.size(found)), F.col(found),
        lambda g, m: F.length(g) + F.length(m))))
    df = df.withColumn(sums, F.when(F.col(gaps).isNotNull(), F.transform(
        F.sequence(F.lit(0), F.expr(f"size({found}) div 64")),
        lambda k: _total(F.slice(F.col(lens), k * 64 + 1, F.lit(64))))))

    def span(m: Column, i: Column) -> Column:
        start = (_total(F.slice(F.col(sums), F.lit(1), F.shiftright(i, 6)))
                 + _total(F.slice(F.col(lens), i - i % 64 + 1, i % 64))
                 + F.length(F.get(F.col(gaps), i)))
        return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value"))
    empty = F.expr("CAST(array() AS array<struct<start:int,end:int,value:string>>)")
    df = df.withColumn(out, F.when(F.col(gaps).isNotNull(), F.transform(F.col(found), span))
                       .otherwise(empty))
    return df.drop(found, gaps, lens, sums)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def part(i: Column) -> Column:
        x = F.substring(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)
    return _total(F.transform(F.sequence(F.lit(1), F.length(digits)), part)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _checked(no: int, kind: str) -> Column:
    good = F.filter(F.col(f"_{kind}"), lambda s: _valid(kind, s["value"]))
    return F.transform(good, lambda s: F.struct(
        s["start"].alias("start"), F.lit(no).alias("no"), s["end"].alias("end"),
        s["value"].alias("value")))


def base_spans(docs: DataFrame) -> DataFrame:
    """Rows of (doc_id, text) with ``spans``: array<struct<start, no, end, value>> by start, then kind."""
    df = docs
    need = {"email": F.contains(F.col("text"), F.lit("@")),
            "phone": F.contains(F.col("text"), F.lit("+"))}
    parts = []
    for no, kind in enumerate(KINDS[:4]):
        df = find(df, "text", PATTERNS[kind], f"_{kind}", need.get(kind))
        parts.append(_checked(no, kind))
    return df.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("spans"))


def _row(text: str = "text") -> Column:
    return F.xxhash64(F.col(text))


def contexts(docs: DataFrame, window: int = 64) -> DataFrame:
    """doc_id, ``row`` (hash of the text) and ``spans`` with the words around them, written once.

    ``left`` and ``right`` are up to ``window`` code points beside a span, without
    a word cut by the window's edge.
    """
    def around(s: Column, whole: Column) -> Column:
        first, size = F.greatest(s["start"] - window, F.lit(0)), whole["size"]
        left = _between(whole["chunks"], first, s["start"])
        right = _between(whole["chunks"], s["end"], F.least(s["end"] + window, size))
        left = F.when(s["start"] > window, F.regexp_replace(left, r"^[^\x20\x09-\x0D]+", "")
                      ).otherwise(left)
        right = F.when(size - s["end"] > window, F.regexp_replace(right, r"[^\x20\x09-\x0D]+$", "")
                       ).otherwise(right)
        return F.struct(s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"),
                        F.lower(F.when(s["no"] == 0, s["value"]).otherwise(_digits(s["value"])))
                        .alias("entity"), left.alias("left"), right.alias("right"))
    # bound as a lambda's variable: made once for a text, and only if it has spans
    each = F.get(F.transform(F.array(_chunked(F.col("text"))), lambda whole: F.transform(
        "spans", lambda s: around(s, whole))), F.lit(0))
    none = F.expr("CAST(array() AS array<struct<start:int,no:int,end:int,entity:string,"
                  "left:string,right:string>>)")
    return durable(base_spans(docs).select(
        "doc_id", _row().alias("row"), F.when(F.size("spans") > 0, each).otherwise(none).alias("spans")))


CHUNK = 4096


def _chunked(text: Column) -> Column:
    """A text's length and its chunks of ``CHUNK`` code points.

    A substring is found by counting from the start of its text; from chunks, many
    substrings of a long text do not cost their number times its length.
    """
    size = F.length(text)
    return F.struct(size.alias("size"), F.transform(
        F.sequence(F.lit(0), F.floor(size / CHUNK).cast("int")),
        lambda j: F.substring(text, j * CHUNK + 1, F.lit(CHUNK))).alias("chunks"))


def _between(chunks: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` up to ``end``."""
    k = F.floor(start / CHUNK).cast("int")
    some = F.array_join(F.slice(chunks, k + 1, F.floor(end / CHUNK).cast("int") - k + 1), "")
    return F.substring(some, start - k * CHUNK + 1, end - start)


def corpus_words(docs: DataFrame) -> DataFrame:
    """``term`` (each word lowered by itself) and its count ``n`` in all documents."""
    words = (docs.select(F.explode(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))).alias("word"))
             .groupBy("word").agg(F.count("*").alias("n")))
    return words.groupBy(F.lower("word").alias("term")).agg(F.sum("n").alias("n"))


def _beside_spans(words: DataFrame, found: DataFrame) -> DataFrame:
    """The ``words`` (doc_id, row, start, end, ...) that overlap no span of ``found``.

    Words and spans of a text are put in one order once: a word is overlapped if a
    span that starts no later ends behind its start, or one that starts no
    earlier starts before its end.
    """
    spans = found.select("doc_id", "row", F.explode("spans").alias("s")).select(
        "doc_id", "row", F.col("s.start").alias("start"), F.col("s.start").alias("from"),
        F.col("s.end").alias("to"))
    rows = words.withColumn("is_word", F.lit(1)).unionByName(
        spans.withColumn("is_word", F.lit(0)), allowMissingColumns=True)
    text = Window.partitionBy("doc_id", "row")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    rising = text.orderBy("start", "is_word").rowsBetween(*so_far)
    falling = text.orderBy(F.desc("start"), "is_word").rowsBetween(*so_far)
    return (rows.withColumn("reach", F.max("to").over(rising))
            .withColumn("next", F.min("from").over(falling)).filter("is_word = 1")
            .filter("NOT (coalesce(reach > start, false) OR coalesce(next < end, false))")
            .select(*words.columns))


def disclosing_terms(docs: DataFrame, found: DataFrame, min_contexts: int, at: float
                     ) -> tuple[DataFrame, DataFrame]:
    """Term occurrences near entities, and the (no, entity, term) pairs that disclose."""
    near = found.select("doc_id", "row", F.explode("spans").alias("s")).select("doc_id", "row", "s.*")
    sides = []
    for side in ("left", "right"):
        words = find(near, side, TERM, "words")
        shift = F.col("start") - F.length("left") if side == "left" else F.col("end")
        sides.append(words.select(
            "doc_id", "row", "no", "entity",
            F.xxhash64("left", "right").alias("context"), shift.alias("shift"),
            F.explode("words").alias("w")))
    near = sides[0].unionByName(sides[1]).select(
        "doc_id", "row", "no", "entity", "context", F.lower("w.value").alias("term"),
        (F.col("w.start") + F.col("shift")).alias("start"),
        (F.col("w.end") + F.col("shift")).alias("end"))
    near = durable(_beside_spans(near, found))
    key = ["no", "entity", "term"]
    pairs = (near.groupBy(*key, "context").agg(F.count("*").alias("n"))
             .groupBy(*key).agg(F.sum("n").alias("n_near"), F.count("*").alias("contexts")))
    entities = pairs.groupBy("no", "entity").agg(F.sum("n_near").alias("n_entity"))
    words = corpus_words(docs)
    total = words.agg(F.sum("n").alias("total"))        # one row
    often = durable(pairs.filter(F.col("contexts") >= min_contexts).join(entities, ["no", "entity"]))
    # a word may be near a third of all entities
    counts = durable(words.join(often.groupBy("term").agg(F.count("*").alias("pairs")), "term"))
    flagged = (join_to_unique(often, counts, ["term"], "pairs", F.xxhash64("no", "entity"))
               .join(F.broadcast(total))
               .withColumn("pmi", F.log2(F.col("n_near") / F.col("n_entity")
                                         / (F.col("n") / F.col("total"))))
               .withColumn("ic", -F.log2(F.col("n_entity") / F.col("total")))
               .withColumn("disclosure", F.when(F.col("ic") > 0, F.col("pmi") / F.col("ic"))))
    return near, flagged.filter(F.col("disclosure") >= at).select(*key, "disclosure")


def term_spans(docs: DataFrame, found: DataFrame, min_contexts: int, generalise_at: float
               ) -> DataFrame:
    """doc_id, row and ``terms``: array<struct<start, no, end, disclosure>> (no = 4)."""
    near, flagged = disclosing_terms(docs, found, min_contexts, generalise_at)
    # a term of one entity may be near a third of all mentions: salted join
    salted = flagged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = (near.withColumn("salt", F.pmod(F.xxhash64("doc_id", "row"), F.lit(SALTS)).cast("int"))
            .join(salted, ["no", "entity", "term", "salt"]))
    return (hits.groupBy("doc_id", "row", "start", "end")
            .agg(F.max("disclosure").alias("disclosure"))
            .groupBy("doc_id", "row")
            .agg(F.collect_list(F.struct("start", F.lit(4).alias("no"), "end", "disclosure"))
                 .alias("terms")))


NO_TERMS = "CAST(array() AS array<struct<start:int,no:int,end:int,disclosure:double>>)"


def spans(docs: DataFrame, window: int = 64, min_contexts: int = 2, generalise_at: float = 0.8,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``terms`` (arrays of struct<start, no, end, ...>) per row.

    ``no`` numbers ``KINDS``. NULL text is empty text and has no spans. Rows
    with equal id and text are judged alike and all kept; NULL ids are a value
    of their own. Empty tables give no rows. Ties: none (a term span found
    for two entities is one span, with the larger disclosure).
    """
    rows = id_text(docs, id_col, text_col)
    found = contexts(rows, window)
    terms = term_spans(rows, found, min_contexts, generalise_at)
    joined = found.alias("f").join(
        terms.alias("t"), F.col("f.doc_id").eqNullSafe(F.col("t.doc_id"))
        & (F.col("f.row") == F.col("t.row")), "left")
    return joined.select("f.doc_id", F.col("f.spans").alias("base"),
                         F.coalesce("t.terms", F.expr(NO_TERMS)).alias("terms"))


def _label(no: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), no + 1)


def listing(spans_col: Column) -> Column:
    """kind:start:end of spans, comma-joined, by start and then kind."""
    ordered = F.array_sort(F.transform(spans_col, lambda s: F.struct(
        s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", _label(s["no"]), s["start"], s["end"])), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """Counts per base kind, digest of the base spans, all spans, and the number of term spans."""
    found = spans(docs, **options)
    narrow = lambda c: F.transform(c, lambda s: F.struct(
        s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end")))
    count = lambda no: F.size(F.filter("base", lambda s: s["no"] == no)).cast("long")
    return found.select(
        "doc_id", *[count(no).alias(f"n_{k}") for no, k in enumerate(KINDS[:4])],
        F.sha2(listing(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listing(F.concat(narrow("base"), narrow("terms"))).alias("spans"),
        F.size("terms").cast("long").alias("n_term"))


def _clean(text: Column, spans_col: Column, remove_at: float) -> Column:
    """Text with spans replaced left to right; overlapping spans are replaced as one.

    Pieces are made span by span and joined once, so nothing grows with every span.
    """
    shape = lambda w: (F.when(w.rlike(r"^\p{N}+$"), "[NUMBER]")
                       .when(w.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]"))

    # the end of all spans before the i-th: maxima of whole chunks of 64, then of its own
    ends = F.transform(spans_col, lambda s: s["end"])
    chunks = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(spans_col), 6)),
                         lambda j: F.array_max(F.slice(ends, j * 64 + 1, F.lit(64))))

    def build(b: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            before = F.coalesce(F.greatest(
                F.array_max(F.slice(b["chunks"], F.lit(1), F.shiftright(i, 6))),
                F.array_max(F.slice(b["ends"], i - i % 64 + 1, i % 64))), F.lit(0))
            word = _between(b["text"]["chunks"], s["start"], s["end"])
            put = (F.when(s["no"] < 4, F.concat(F.lit("["), F.upper(_label(s["no"])), F.lit("]")))
                   .when(s["disclosure"] >= remove_at, "").otherwise(shape(word)))
            gap = _between(b["text"]["chunks"], before, s["start"])
            return F.when(s["start"] >= before, F.concat(gap, put)).otherwise("")
        rest = F.coalesce(F.array_max(b["ends"]), F.lit(0))
        return F.concat(F.array_join(F.transform(spans_col, piece), ""),
                        F.substring(text, rest + 1, b["text"]["size"]))
    # bound as a lambda's variable, so that the arrays are made once
    bound = F.struct(ends.alias("ends"), chunks.alias("chunks"), _chunked(text).alias("text"))
    return F.get(F.transform(F.array(bound), build), F.lit(0))


def sanitise(docs: DataFrame, window: int = 64, min_contexts: int = 2, generalise_at: float = 0.8,
             remove_at: float = 0.95, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by its kind, disclosing terms
    generalised to their shape or removed; all other columns as they are.

    Rows without personal data pass unchanged (NULL text stays NULL). Spans
    are kept per (id, text), so rows equal in both are cleaned alike.
    """
    rows = id_text(docs, id_col, text_col)
    found = contexts(rows, window)
    terms = term_spans(rows, found, min_contexts, generalise_at)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
                         docs[id_col].cast("long").alias("doc_id"),
                         F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    base = found.filter(F.size("spans") > 0).select(
        "doc_id", "row", F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"),
            F.lit(None).cast("double").alias("disclosure"))).alias("base"))
    same = lambda a, b: (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
                         & (F.col(f"{a}.row") == F.col(f"{b}.row")))
    marks = (base.distinct().alias("b").join(terms.alias("t"), same("b", "t"), "left")
             .select("b.doc_id", "b.row", F.array_sort(F.concat(
                 F.col("b.base"), F.coalesce("t.terms", F.expr(NO_TERMS)))).alias("spans")))
    keyed = packed.withColumn("row", _row())
    marked = keyed.alias("d").join(marks.alias("m"), same("d", "m"), "left")
    cleaned = F.when(F.col("m.spans").isNotNull(),
                     _clean(F.col("d.text"), F.col("m.spans"), remove_at)
                     ).otherwise(F.col(f"d.whole.{text_col}"))
    return marked.select(*[(cleaned if c == text_col else F.col(f"d.whole.`{c}`")).alias(c)
                           for c in docs.columns])

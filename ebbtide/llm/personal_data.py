"""Personal data in texts, and terms that give it away, with DataFrame functions only.

Emails, addresses, card and phone numbers are found by patterns; these are the protected entities. Which terms reveal them is estimated
from the corpus: a term stands in the context of an entity (a few words to both sides), and the pointwise mutual information of
term and entity, over the information of the entity itself, is the part of the entity that the term discloses (1: who reads
the term knows the entity). Shares are counted in rows, so copies change numerator and
denominator alike; as proof against chance, contexts that are copies of each other count once. A term whose share reaches a threshold is marked in the documents
that hold the entity: removed if it tells nearly all, else generalised.

The patterns are written so that long runs of digits or letters cost linear time and no stack: runs are possessive, and a
match begins where its run begins or where the match before ended, which gives the same matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import join_hot, let, packed, running, stored, text_or_empty, unpacked

_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
WORD = r"\p{L}{3,}"
CONTEXT_WORDS = 5
CONTEXT_CHARS = 200
CHUNK = 1024
#: Rows of a term that share one copy of its pairs, and the most copies.
ROWS_PER_COPY, MOST_COPIES = 1 << 14, 1 << 12
#: Contexts at the entity's base rate that are added to those of each term: few contexts prove little, none is left out.
PSEUDO_CONTEXTS = 1.0
#: Parts of an entity's information from which a term is generalised, and from which it is removed.
GENERALISE, REMOVE = 0.8, 0.95
_SPAN = "array<struct<start: long, end: long, value: string>>"


def spans_of(text: Column, pattern: str) -> Column:
    """Matches as code points, end exclusive, leftmost and without overlaps: the texts between the matches give the places."""
    size = lambda s: F.length(s).cast("long")

    def spans(found: Column) -> Column:
        matches, between = found["matches"], found["between"]
        # Running ends of "text before, match" pairs.
        steps = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda b, m: size(b) + size(m))
        made = F.zip_with(
            running(steps, lambda x, y: x + y), matches, lambda e, m: F.struct((e - size(m)).alias("start"), e.alias("end"), m.alias("value"))
        )
        return F.when(F.size(matches) > 0, made).otherwise(F.array().cast(_SPAN))

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("between"))
    return let(both, spans)


def chunks_of(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points, from which stretches are taken without counting from the text's start each time."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def piece(chunks: Column, start: Column, end: Column) -> Column:
    first = F.floor(start / CHUNK).cast("int")
    count = F.floor((F.greatest(end, start + 1) - 1) / CHUNK).cast("int") - first + 1
    joined = F.array_join(F.slice(chunks, first + 1, count), "")
    return F.when(end > start, F.substr(joined, (start % CHUNK + 1).cast("int"), (end - start).cast("int"))).otherwise(F.lit(""))


def replaced(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """The text with each span replaced by its label. Spans that overlap are replaced together, by the label of the first."""
    def made(own: Column) -> Column:
        chunks, listed, tops = own["chunks"], own["spans"], own["tops"]
        before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.element_at(tops, i))
        # The place before 1 does not exist, so the index of the first span isn't used.
        parts = F.transform(listed, lambda s, i: let(before(i), lambda top: F.when(
            s["start"] >= top, F.concat(piece(chunks, top, s["start"]), label(s))).otherwise(F.lit(""))))
        return F.concat(F.array_join(parts, ""), piece(chunks, F.element_at(tops, -1), F.length(text).cast("long")))

    ordered = F.array_sort(spans)
    facts = let(ordered, lambda s: F.struct(
        chunks_of(text).alias("chunks"), s.alias("spans"), running(F.transform(s, lambda x: x["end"]), F.greatest).alias("tops")))
    return F.when(F.size(spans) > 0, let(facts, made)).otherwise(text)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _byte_parts(value: Column) -> Column:
    small = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(value, r"\."), lambda p: (F.length(small(p)) <= 3) & (F.substring(small(p), 1, 3).cast("int") <= 255))


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def doubled(i: Column) -> Column:
        d = F.ascii(F.substr(digits, n - i + 1, F.lit(1))) - 48
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + doubled(i))
    return total % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each kind that pass its test."""
    number = text.rlike("[0-9]")
    none = F.array().cast(_SPAN)
    has = {"email": F.contains(text, F.lit("@")), "ip": number, "card": number, "phone": F.contains(text, F.lit("+")) & number}
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    count = lambda v: F.length(_digits(v))
    test = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: _byte_parts(s["value"]),
        "card": lambda s: F.when(count(s["value"]).between(13, 19), luhn(_digits(s["value"]))).otherwise(F.lit(False)),
        "phone": lambda s: count(s["value"]).between(9, 15),
    }
    return {k: F.when(has[k], F.filter(spans_of(text, pattern[k]), test[k])).otherwise(none) for k in KINDS}


def _listed(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def span_text(columns: dict[str, str]) -> Column:
    """``kind:start:end`` of all spans, by kind as listed, then start, joined by commas. columns: kind to column name."""
    return F.array_join(F.concat(*[_listed(F.col(c), k) for k, c in columns.items()]), ",")


def _entity(kind: str, value: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value))


def _contexts(found: DataFrame, text: Column, words_around: int, chars_around: int) -> DataFrame:
    """(row, entity, terms, mark): the words around each protected span. mark tells copies of a context."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))

    def around(chunks: Column, k: str) -> Column:
        def one(s: Column) -> Column:
            before = piece(chunks, F.greatest(F.lit(0).cast("long"), s["start"] - chars_around), s["start"])
            after = piece(chunks, s["end"], F.least(s["end"] + chars_around, F.length(text).cast("long")))
            near = F.concat(F.slice(F.reverse(words(before)), 1, words_around), F.slice(words(after), 1, words_around))
            return F.struct(_entity(k, s["value"]).alias("entity"), near.alias("terms"))

        return F.transform(F.col(f"_{k}"), one)

    every = let(chunks_of(text), lambda chunks: F.concat(*[around(chunks, k) for k in KINDS]))
    rows = found.where("_any").select("_row", F.explode(every).alias("_s"))
    return rows.select("_row", "_s.entity", "_s.terms").withColumn("mark", F.xxhash64("terms"))


def term_documents(docs: DataFrame) -> DataFrame:
    """(term, documents) over all texts; counts leave each task as one row per term."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty()), F.lit(WORD), F.lit(0)))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("documents"))


def disclosing_terms(contexts: DataFrame, terms: DataFrame, total: int, part: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosed, documents): the part of the entity's information that the term gives, where it reaches ``part``.

    Pairs of a single context are rated too. Against chance the entity's share of a term is drawn to the entity's share of all texts.
    """
    total = float(max(total, 1))
    entities = contexts.groupBy("entity").agg(F.count_distinct("_row").alias("n_entity"))
    # A row may hold an entity many times, and a context in many copies.
    each = contexts.select("_row", "entity", "mark", F.explode(F.array_distinct("terms")).alias("term"))
    pairs = each.groupBy("entity", "term").agg(F.count_distinct("_row").alias("n_both"), F.count_distinct("mark").alias("n_contexts"))
    pairs = stored(pairs)
    # An entity can have very many terms, and a term stand beside very many entities.
    spread = F.concat(F.lit("#"), F.col("entity"), F.lit("#"), F.col("term"))
    of_entity = stored(pairs.groupBy("entity").agg(F.count(F.lit(1)).alias("_pairs")).join(entities, "entity"))
    of_term = stored(pairs.groupBy("term").agg(F.count(F.lit(1)).alias("_beside")).join(terms, "term"))
    joined = join_hot(join_hot(pairs, of_entity, "entity", "_pairs", spread), of_term, "term", "_beside", spread).where("documents is not null")
    # Shares are of rows, copies among them on both sides; how far a share is trusted depends on different contexts only.
    share = F.col("n_both") / F.greatest("documents", "n_both")
    base = F.col("n_entity") / F.lit(total)
    proof = F.least("n_contexts", "n_both")
    smoothed = (proof + PSEUDO_CONTEXTS * base) / (proof / share + PSEUDO_CONTEXTS)
    information = -F.log2(base)
    told = F.when(information > 0, F.log2(smoothed / base) / information).otherwise(F.lit(0.0))
    return joined.withColumn("disclosed", told).where(F.col("disclosed") >= part).select("entity", "term", "disclosed", "documents")


def personal_data(
    docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, context_words: int = CONTEXT_WORDS,
    context_chars: int = CONTEXT_CHARS,
) -> DataFrame:
    """The columns of ``docs`` and email, ip, card, phone, term (arrays of start, end, value) and sanitised.

    Offsets are code points, end exclusive. ``sanitised`` is the text with each protected span replaced by its kind, general terms by
    ``[TERM]``, and disclosing ones left out; spans that overlap are replaced together, as the first of them. A context is what stands within
    ``context_words`` words and ``context_chars`` characters to each side. Null texts count as empty; repeated rows are treated each;
    an empty table gives no rows. Columns of ``docs`` with the six names are replaced.
    """
    needed = ["text"]
    text = text_or_empty()
    base = packed(docs, needed)
    marked = base.select("*", *[c.alias(f"_{k}") for k, c in base_spans(text).items()])
    flagged = marked.withColumn("_any", F.greatest(*[F.size(f"_{k}") for k in KINDS]) > 0)
    # Rows get a number that stays, so rows that repeat an id are apart; the patterns are run once.
    found = stored(flagged.withColumn("_row", F.monotonically_increasing_id()))
    contexts = stored(_contexts(found, text, context_words, context_chars))
    told = disclosing_terms(contexts, term_documents(found), found.count(), generalise)
    of_rows = contexts.select("_row", "entity").distinct()
    # The words of a row meet the pairs of a term and an entity it discloses, dealt out by salts, and those the entities of the row.
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))))
    of_words = found.where("_any").select("_row", word.alias("term"))
    each = _meeting(of_words, stored(told.select("entity", "term", (F.col("disclosed") >= remove).alias("remove"), "documents")))
    here = each.join(of_rows, ["_row", "entity"]).groupBy("_row", "term").agg(F.max("remove").alias("remove"))
    by_row = here.groupBy("_row").agg(F.collect_list(F.struct("term", "remove")).alias("_terms"))
    wanted = F.transform("_terms", lambda t: t["term"])
    gone = F.transform(F.filter("_terms", lambda t: t["remove"]), lambda t: t["term"])
    # Words inside a protected span are covered by it already: it is written as digits of the same length.
    protected = F.concat(*[F.col(f"_{k}") for k in KINDS])
    plain = F.transform(protected, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    masked = _masked(text, plain)
    spans = F.filter(spans_of(masked, WORD), lambda s: F.array_contains(wanted, F.lower(s["value"])))
    none = F.array().cast(_SPAN)
    # Only rows with a protected span can lose a term; the others are not moved.
    touched = found.where("_any").join(by_row, "_row", "left").withColumns({
        "term": F.when(F.col("_terms").isNotNull(), spans).otherwise(none), "_gone": F.coalesce(gone, F.array().cast("array<string>")),
    })
    clean = found.where("not _any").withColumns({"term": none, "sanitised": text}).drop("_any", "_row")
    done = touched.withColumn("sanitised", _sanitised(text)).drop("_any", "_row", "_terms", "_gone").unionByName(clean)
    return unpacked(done, docs, needed, {**{k: F.col(f"_{k}") for k in KINDS}, "term": F.col("term"), "sanitised": F.col("sanitised")})


def _meeting(of_words: DataFrame, told: DataFrame) -> DataFrame:
    """(row, term, entity, remove) of each word of a row that discloses an entity. A word may stand in very many rows."""
    copies = F.least(F.lit(MOST_COPIES), F.ceil(F.col("documents") / ROWS_PER_COPY)).cast("int")
    dealt = told.withColumn("_copies", copies)
    listed = dealt.groupBy("term").agg(F.max("_copies").alias("_copies"), F.max("documents").alias("_documents"))
    sized = join_hot(of_words, stored(listed), "term", "_documents", F.concat(F.lit("#"), F.col("_row").cast("string"))).where("_copies is not null")
    salted = sized.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.col("_copies")).cast("int")).select("_row", "term", "_salt")
    every = dealt.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    return salted.join(every.select("term", "_salt", "entity", "remove"), ["term", "_salt"]).select("_row", "term", "entity", "remove")


def _masked(text: Column, spans: Column) -> Column:
    """The text with all spans written as digits; its places stay the same."""
    def made(own: Column) -> Column:
        chunks, listed, tops = own["chunks"], own["spans"], own["tops"]
        parts = F.transform(listed, lambda s, i: let(
            F.when(i == 0, F.lit(0).cast("long")).otherwise(F.element_at(tops, i)),
            lambda top: F.concat(piece(chunks, top, s["start"]), F.repeat(F.lit("0"), (s["end"] - F.greatest(s["start"], top)).cast("int"))),
        ))
        return F.concat(F.array_join(parts, ""), piece(chunks, F.element_at(tops, -1), F.length(text).cast("long")))

    facts = let(F.array_sort(spans), lambda s: F.struct(
        chunks_of(text).alias("chunks"), s.alias("spans"), running(F.transform(s, lambda x: x["end"]), F.greatest).alias("tops")))
    return F.when(F.size(spans) > 0, let(facts, made)).otherwise(text)


def _sanitised(text: Column) -> Column:
    labelled = lambda k: F.transform(
        F.col(f"_{k}"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{k.upper()}]").alias("label"))
    )
    terms = F.transform(
        "term",
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.when(F.array_contains(F.col("_gone"), F.lower(s["value"])), F.lit("")).otherwise(F.lit("[TERM]")).alias("label"),
        ),
    )
    return replaced(text, F.concat(*[labelled(k) for k in KINDS], terms), lambda s: s["label"])

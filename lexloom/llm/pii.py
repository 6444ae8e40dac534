"""Personal data: spans of four fixed kinds, and terms that reveal them. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexloom.llm.filters import bit_filter
from lexloom.llm.store import keep, row_key

#: Kinds in their order. The method's own are secrets, which carry much information in themselves, and terms, which
#: co-occurrence shows to reveal protected entities.
KINDS = ("email", "ip", "card", "phone", "secret", "term")
#: What a document must hold for its kind's pattern to be tried, and the pattern. Runs are taken whole and never given
#: back, and an attempt starts at a run's beginning or where the last match ended, so that long runs take linear time.
PATTERNS = {
    "email": ("instr({t}, '@') > 0", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"{t} rlike r'[0-9]\.[0-9]'", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"),
    "card": (r"{t} rlike r'[0-9](?:[\x20-]?[0-9]){{13}}'", r"[0-9](?:[\x20-]?[0-9]){13,}+"),
    "phone": (r"{t} rlike r'\+[0-9]'", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "secret": (r"{t} rlike r'[A-Za-z0-9_]{{24}}'", r"(?:(?<![A-Za-z0-9_])|\G)[A-Za-z0-9_]{24,}+"),
}
_DIGITS = "regexp_replace(m, '[^0-9]', '')"
#: When a match m counts.
VALID = {
    "email": "true",
    "ip": r"forall(split(m, r'\.'), x -> length(regexp_replace(x, '^0+', '')) <= 3 and coalesce(try_cast(x as decimal(38,0)), 0) <= 255)",
    "card": f"""case when length({_DIGITS}) between 14 and 19 then aggregate(sequence(1, length({_DIGITS})), 0, (a, i) -> a +
        case when i % 2 = 1 then cast(substr({_DIGITS}, -i, 1) as int)
             when substr({_DIGITS}, -i, 1) > '4' then 2 * cast(substr({_DIGITS}, -i, 1) as int) - 9
             else 2 * cast(substr({_DIGITS}, -i, 1) as int) end) % 10 = 0 else false end""",
    "phone": f"length({_DIGITS}) between 10 and 15",
    # Letters and digits, and at least three bits a character by the string's own frequencies.
    "secret": f"""length({_DIGITS}) >= 4 and length(m) - length({_DIGITS}) >= 4 and aggregate(array_distinct(split(m, '')), 0.0D,
        (a, c) -> a - (length(m) - length(replace(m, c, ''))) * log2((length(m) - length(replace(m, c, ''))) / length(m)) / length(m)) >= 3.0""",
}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Words on either side of an entity that count as near it, up to the next entity of its kind and within so many characters; a word
#: that this cuts is left out.
NEAR, REACH = 6, 240
#: A term reveals an entity if it stands near it in so many different contexts, in at least this share of the documents
#: that hold the term (so that it tells all but one bit of what the entity itself tells), and if they meet so many bits
#: more often than by chance.
CONTEXTS, DISCLOSURE, BITS = 3, 0.5, 3.0
#: Bits of the filter through which the corpus' words pass before they are counted: of fixed size, it may let more pass.
FILTER_BITS = 1 << 20
#: Items that are summed up together: sums over an array are made of sums of so many.
STEP = 128

_SPAN = "struct<start:int,kind:int,end:int>"
_FOUND = "struct<start:int,kind:int,end:int,m:string,before:string,after:string>"


def _let(name: str, value: str, body: str) -> str:
    """SQL for body with a name for value, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _running(lengths: str) -> str:
    """SQL for the sums of all items before each item of an array that has a name."""
    steps = f"transform(sequence(0, cast(greatest(0, size({lengths}) - 1) div {STEP} as int)), c -> aggregate(slice({lengths}, c * {STEP} + 1, {STEP}), 0, (a, y) -> a + y))"
    blocks = _let("totals", steps, "transform(totals, (y, c) -> named_struct('c', c, 'off', aggregate(slice(totals, 1, c), 0, (a, z) -> a + z)))")
    return f"flatten(transform({blocks}, b -> transform(slice({lengths}, b.c * {STEP} + 1, {STEP}), (y, j) -> b.off + aggregate(slice({lengths}, b.c * {STEP} + 1, j), 0, (a, z) -> a + z))))"


def _spans(text: str, pattern: str, kind: int, valid: str = "true") -> str:
    """SQL for the valid matches of a pattern, with the text on either side up to the next match: places are running sums of the
    lengths of what stands between matches, and of the matches."""
    made = f"""transform(sequence(1, size(p.m)), i -> named_struct('start', element_at(at, 2 * i), 'kind', {kind}, 'end', element_at(at, 2 * i + 1),
        'm', element_at(p.m, i), 'before', element_at(p.g, i), 'after', element_at(p.g, i + 1)))"""
    lengths = "transform(sequence(0, 2 * size(p.m)), i -> length(if(i % 2 = 0, element_at(p.g, shiftright(i, 1) + 1), element_at(p.m, shiftright(i + 1, 1)))))"
    placed = _let("n", lengths, _let("at", _running("n"), made))
    found = _let("p", f"named_struct('g', split({text}, {pattern}, -1), 'm', regexp_extract_all({text}, {pattern}, 0))", f"if(size(p.m) = 0, cast(array() as array<{_FOUND}>), {placed})")
    return f"filter({found}, s -> {_let('m', 's.m', valid)})"


def _text(items: Column) -> Column:
    """Spans as kind:start:end, comma-joined, by start and then kind."""
    return F.array_join(F.transform(F.array_sort(items), lambda s: F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"], s["end"])), ",")


def base_spans(text: str = "text") -> Column:
    """Array of (start, kind, end, m, before, after) of the kinds of PATTERNS: code points, end exclusive; m is what was matched."""
    parts = []
    for number, (kind, (when, pattern)) in enumerate(PATTERNS.items()):
        parts.append(f"if({when.format(t=text)}, {_spans(text, _literal(pattern), number, VALID[kind])}, cast(array() as array<{_FOUND}>))")
    return F.expr(f"concat({', '.join(parts)})")


def _literal(pattern: str) -> str:
    return "r'" + pattern + "'"


def _terms_of(base: DataFrame, source: DataFrame) -> DataFrame:
    """(entity, term): terms whose co-occurrence in the corpus reveals a protected entity."""
    # All counts are of documents, each of which counts once for a pair; contexts only support it.
    named = base.select(_pairs("concat_ws('\u0001', n, t, e.context)").alias("met")).select(F.explode("met").alias("x")).distinct()
    contexts = named.select(F.substring_index("x", "\u0001", 2).alias("pair")).groupBy("pair").agg(F.count("*").alias("contexts")).where(F.col("contexts") >= CONTEXTS)
    together = base.select(_pairs("concat_ws('\u0001', n, t)").alias("met")).select(F.explode("met").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    pairs = together.join(contexts.select("pair"), "pair").select(F.substring_index("pair", "\u0001", 1).alias("entity"), F.substring_index("pair", "\u0001", -1).alias("term"), "n")
    pairs = keep(pairs, "terms")
    # The only thing that goes to all tasks, of a fixed size.
    passes = bit_filter(pairs, "term", FILTER_BITS, "filter")
    words = source.select(F.explode(F.array_distinct(F.expr(f"regexp_extract_all(lower_ascii, r'{WORD}+', 0)"))).alias("term"))
    # Each document has a word once, so that plain counts are summed up in each task before the shuffle.
    docs_with = words.where(passes("term")).groupBy("term").agg(F.count("*").alias("df"))
    entity_docs = base.select(F.explode(F.expr("array_distinct(flatten(transform(entities, e -> array(e.entity, e.kind))))")).alias("entity")).groupBy("entity").agg(F.count("*").alias("ef"))
    total = source.agg(F.count("*").alias("total"))
    scored = pairs.join(docs_with, "term").join(entity_docs, "entity").withColumn("total", total.scalar())
    strong = scored.where((F.col("n") >= DISCLOSURE * F.col("df")) & (F.log2(F.col("n") * F.col("total") / (F.col("df") * F.col("ef"))) >= BITS))
    return strong.select("entity", "term")


def _pairs(said: str) -> Column:
    """Distinct strings for each entity n (a value or its kind) and word t near it of a document; said: SQL of n, t and e."""
    near = "filter(array_distinct(concat(e.before, e.after)), t -> length(t) >= 3 and not t rlike '^[0-9]+$')"
    return F.expr(f"array_distinct(flatten(transform(entities, e -> flatten(transform(array(e.entity, e.kind), n -> transform({near}, t -> {said}))))))")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, k (row_key() of id and text), base (spans of fixed kinds: start, kind, end), found (these and the method's).

    Fixed kinds are the first four of PATTERNS, leftmost and non-overlapping within a kind; matches that fail VALID are dropped.
    The method adds secrets, by the information in the string itself, and terms, by what the corpus says about them. Protected
    entities are the values of all these spans, and their kinds. A term that stands near an entity in CONTEXTS different contexts, in
    DISCLOSURE of all documents that hold the term, and with BITS of pointwise mutual information, reveals it; it is a span
    wherever it stands in a document in which it stands near that entity. Near is within NEAR words and REACH characters, and not beyond the next
    entity of the kind; terms that only stand further away are not found. All counts are of documents, over the whole
    corpus, so that copies count alike for terms and entities; those of terms are of words that pass a filter of fixed size.

    Kinds in spans are numbers in the order of KINDS. Null texts are empty and have no spans; rows of null or repeated ids
    are kept as they are; other columns are left out, whatever their names; an empty table gives an empty result.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("k", row_key("doc_id", "text"))
    base = keep(source.select("doc_id", "k", base_spans().alias("b")).select("doc_id", "k", F.expr("transform(b, s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end))").alias("b"), _contexts().alias("entities")), "base")
    terms = keep(_terms_of(base.where("size(entities) > 0"), source.select(_lower("text").alias("lower_ascii"))), "revealing")
    # Only the words near entities are sought among the terms; a larger side than Spark's broadcast limit is joined by a shuffle.
    near = base.select("k", F.explode(_pairs("concat_ws('\u0001', n, t)")).alias("pair")).join(terms.select(F.concat_ws("\u0001", "entity", "term").alias("pair")), "pair")
    flagged = near.groupBy("k").agg(F.sort_array(F.collect_set(F.substring_index("pair", "\u0001", -1))).alias("terms"))
    marked = source.join(keep(flagged, "flagged"), "k").withColumn("pattern", F.concat(F.lit(f"(?i)(?<!{WORD})(?:"), F.array_join(F.reverse("terms"), "|"), F.lit(f")(?!{WORD})")))
    added = marked.select("k", F.expr(f"transform({_spans('text', 'pattern', len(KINDS) - 1)}, s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end))").alias("t")).groupBy("k").agg(F.first("t").alias("t"))
    none = F.expr(f"cast(array() as array<{_SPAN}>)")
    out = base.join(keep(added, "added"), "k", "left")
    return out.select("doc_id", "k", F.filter("b", lambda s: s["kind"] < 4).alias("base"), F.array_sort(F.concat("b", F.coalesce("t", none))).alias("found"))


def _lower(text: str) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _contexts() -> Column:
    """Entities of a document (entity, kind, before, after, context) with the words near each, and a hash of these."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lower}, r'{WORD}+', 0)"
    before = words.format(f"if(length(s.before) > {REACH}, regexp_replace(right(s.before, {REACH}), r'^{WORD}+', ''), s.before)")
    after = words.format(f"if(length(s.after) > {REACH}, regexp_replace(left(s.after, {REACH}), r'{WORD}+$', ''), s.after)")
    found = f"""transform(b, s -> named_struct('entity', concat(s.kind, ':', lower(s.m)), 'kind', concat(s.kind, ''),
        'before', reverse(slice(reverse({before}), 1, {NEAR})), 'after', slice({after}, 1, {NEAR})))"""
    return F.expr(f"transform({found}, e -> named_struct('entity', e.entity, 'kind', e.kind, 'before', e.before, 'after', e.after, 'context', hex(xxhash64(e.before, e.after))))")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of base spans, and all spans as text, from personal_data()."""
    count = [F.expr(f"cast(size(filter(base, s -> s.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return found.select("doc_id", *count, F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.col("found")).alias("spans"))


def sanitised(text: str = "text", found: str = "found") -> Column:
    """The text with each span replaced by its kind in brackets, the most general thing to say of it; spans that overlap are
    replaced as one, by the first's kind. Spans must be in order, as found has them; they are replaced STEP at a time."""
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    # For each block: what its spans say, the end of all spans before it, and the text from there to where the block's last span ends.
    blocks = f"transform(sequence(0, cast((size({found}) - 1) div {STEP} as int)), c -> named_struct('s', slice({found}, c * {STEP} + 1, {STEP}), 'c', c))"
    ends = f"transform({blocks}, b -> aggregate(b.s, 0, (a, s) -> greatest(a, s.end)))"
    ahead = "transform(ends, (e, i) -> aggregate(slice(ends, 1, i), 0, (a, y) -> greatest(a, y)))"
    inner = f"""concat_ws('', aggregate(b.s, named_struct('at', element_at(ahead, b.c + 1), 'out', cast(array() as array<string>)),
        (a, s) -> if(s.start < a.at, named_struct('at', greatest(a.at, s.end), 'out', a.out),
            named_struct('at', s.end, 'out', concat(a.out, array(substring(part, a.at - element_at(ahead, b.c + 1) + 1, s.start - a.at), element_at({names}, s.kind + 1))))),
        a -> a.out))"""
    part = f"substring({text}, element_at(ahead, b.c + 1) + 1, greatest(0, element_at(ends, b.c + 1) - element_at(ahead, b.c + 1)))"
    body = f"concat(array_join(transform({blocks}, b -> {_let('part', part, inner)}), ''), substring({text}, array_max(ends) + 1))"
    return F.expr(f"if({text} is null or size({found}) = 0, {text}, {_let('ends', ends, _let('ahead', ahead, body))})")

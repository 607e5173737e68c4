"""PII by bootstrapped contextual extraction, in DataFrame functions only.

Seeds are the matches of the base patterns (e-mail, IPv4 address, payment card, phone number) and long
hexadecimal secrets. The words around an occurrence are its lexical patterns: one, two or three
pieces before it, one after it, and the pair around it. Patterns and instances (normalised values)
form a bipartite graph. In each round a pattern's confidence is the share of its distinct instances that
are trusted, seeds fully and found ones by their score; patterns of high confidence and support give
their other instances a noisy-or score, and instances above `MIN_SCORE` are trusted in the next round. Rounds end when
the trusted instances and their scores are the last round's (they only grow, as trust adds to the patterns' confidence); a warning
is logged if that isn't so after `ROUNDS`. Only identifier-like tokens (with a digit or an
at sign) and runs of such groups (`078 05 1120`, `(555) 123 4567`) can be instances, so words are left alone. A value with fewer
than four digits may stand for something else elsewhere: its node is bound to the patterns around it, so only they can find it.

A pattern's pieces are looked for within `CONTEXT_CHARS` code points on either side; a longer piece counts by its part within.
Work in one text follows its length: places add up block by block, spans are merged in one pass, and
contexts are read from pieces of the text.

Defined cases: null and empty texts have no spans; repeated rows each have their spans, and their instances
count once; null doc_ids are kept; an empty table gives no row; other columns are kept by `mask`.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_record, once, with_text, written

KINDS = ("email", "ip", "card", "phone")  # base kinds in the order of the digest; found kinds follow by name

# Linear forms of the base patterns: possessive quantifiers and run starts give the same leftmost
# matches without backtracking or recursion. (?<!x)|\G: at the start of a run, or right after a match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![A-Za-z0-9._%+@/-])(?=[A-Za-z._%+/-]*+[0-9@])[A-Za-z0-9._%+@/-]++"
# Groups with a digit (short capitals may stand between) with one space, bracket, dot, hyphen or slash between; longer rows are tables of numbers
_GROUP = r"(?=[A-Za-z]*+[0-9])[A-Za-z0-9]++"
_NEXT = rf"(?:\)[\x20-]?|\x20\(?|[./-])(?:[A-Z]{{2,5}}\x20)?{_GROUP}"
RUN = rf"(?<![A-Za-z0-9._%+@/-])(?<![0-9]\x20)\(?{_GROUP}(?:{_NEXT}){{1,8}}+(?!{_NEXT})(?![A-Za-z0-9_%+@/]|[.-][A-Za-z0-9])"
SECRET = "^(?=.*[a-f])(?=.*[0-9])[0-9a-f]{32,}$"

CONTEXT_CHARS = 120  # looked at on either side of an occurrence, for at most three pieces
MIN_DIGITS = 4  # of a value that is one instance wherever it stands
MIN_CHARS = 2
ROUNDS = 50  # bound; rounds end earlier once nothing changes
MIN_SUPPORT = 3  # trusted distinct instances a pattern needs
MIN_CONFIDENCE = 0.8
MIN_SCORE = 0.9

BLOCK = 64  # items of a step along an array
CHUNK = 256  # code points; a text is cut so that a place in it is reached without a walk from its start
PLACE = "struct<start:bigint,end:bigint,value:string>"
SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _emitted(items: Column, state: Column, kind: str, step) -> Column:
    """What `step` gives out along an array: step(state, item) is a struct of the next state and an array<kind> of what it gives out.

    Goes block by block, so that an item is moved a bounded number of times and not once for each item after it. The finish of
    `aggregate` names a value without copying it, which `once` would do with all that was given out so far.
    """
    none, nones = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def add(a: Column, i: Column) -> Column:
        return F.aggregate(F.array().cast("array<int>"), step(a["state"], F.get(items, i)), lambda r, _: r,
                           lambda r: F.struct(r["state"].alias("state"), F.concat(a["out"], r["out"]).alias("out")))

    def block(a: Column, first: Column) -> Column:
        places = F.sequence(first, F.least(first + BLOCK, F.size(items)) - 1)
        return F.aggregate(places, F.struct(a["state"].alias("state"), none.alias("out")), add,
                           lambda r: F.struct(r["state"].alias("state"), F.concat(a["out"], F.array(r["out"])).alias("out")))

    firsts = F.sequence(F.lit(0), F.size(items) - 1, F.lit(BLOCK))
    done = F.aggregate(firsts, F.struct(state.alias("state"), nones.alias("out")), block, lambda a: F.flatten(a["out"]))
    return F.when(F.size(items) > 0, done).otherwise(none)


def _matches(text: Column, regex: str) -> Column:
    """All matches as structs (start, end, value), positions in code points: gaps and values add up."""
    values = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    pairs = F.filter(F.zip_with(F.split(text, regex, -1), values, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))),
                     lambda p: p["value"].isNotNull())

    def step(at: Column, x: Column) -> Column:
        return once(at + F.char_length(x["gap"]), lambda start: once(start + F.char_length(x["value"]), lambda end: F.struct(
            end.alias("state"), F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))).alias("out"))))

    return once(pairs, lambda found: _emitted(found, F.lit(0).cast("long"), PLACE, step))


def _chunks(text: Column) -> Column:
    """The text in pieces of CHUNK code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _near(chunks: Column, start: Column, end: Column) -> Column:
    """Code points start to end, at most CHUNK of them, so within two chunks."""
    return once(F.floor(start / CHUNK).cast("int"), lambda i: F.substring(
        F.concat(F.coalesce(F.get(chunks, i), F.lit("")), F.coalesce(F.get(chunks, i + 1), F.lit(""))),
        (start - i * CHUNK + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int")))


def _part(chunks: Column, start: Column, end: Column) -> Column:
    """Code points start to end; an array is cut only for parts longer than a chunk, of which a text has few."""
    first = F.floor(start / CHUNK).cast("int")
    some = F.slice(chunks, first + 1, F.floor((end - 1) / CHUNK).cast("int") - first + 1)
    long = F.substring(F.array_join(some, ""), (start - first * CHUNK + 1).cast("int"), (end - start).cast("int"))
    return F.when(end - start <= CHUNK, _near(chunks, start, end)).otherwise(long)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _luhn(value: Column) -> Column:
    """The digits pass the Luhn test."""
    shown = F.filter(F.split(F.reverse(_digits(value)), ""), lambda c: c != "")
    doubled = F.transform(shown, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: once(
            F.regexp_replace(p, "^0+", ""), lambda q: (F.char_length(q) <= 3) & (F.coalesce(q.try_cast("int"), F.lit(0)) <= 255)))
    size = F.char_length(_digits(value))
    if kind == "card":
        return size.between(16, 19) & _luhn(value)
    return size.between(8, 15)


_HAS = {"email": "@", "phone": "+"}  # a plain search first
_RULES = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}


def base_spans(text: Column) -> Column:
    """Valid matches of the base kinds: kind, start, end, value; by kind as listed, then start."""
    no_spans = F.array().cast(SPAN)

    def of(kind: str) -> Column:
        found = F.filter(_matches(text, _RULES[kind]), lambda m: _valid(kind, m["value"]))
        spans = F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"),
                                                      m["end"].alias("end"), m["value"].alias("value"))).cast(SPAN)
        there = F.contains(text, F.lit(_HAS[kind])) if kind in _HAS else text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else "[0-9][ -]?[0-9]")
        return F.when(there, spans).otherwise(no_spans)

    return F.concat(*[of(k) for k in KINDS])


def _apart(found: Column, taken: Column) -> Column:
    """Those of `found` (disjoint, sorted) that overlap none of `taken`: one pass over both by start.

    A found one waits until the next one of either kind is known to begin after it.
    """
    place = lambda s, free: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(free).alias("free"), s["value"].alias("value"))
    last = F.struct(F.lit(2**62).alias("start"), F.lit(2**62).alias("end"), F.lit(True).alias("free"), F.lit("").alias("value"))
    both = F.concat(F.sort_array(F.concat(F.transform(found, lambda s: place(s, True)), F.transform(taken, lambda s: place(s, False)))), F.array(last))
    none = F.array().cast(f"array<{PLACE}>")
    zero = F.struct(F.lit(0).cast("long").alias("covered"), none.alias("waits"))

    def step(a: Column, x: Column) -> Column:
        hit = F.exists(a["waits"], lambda w: w["end"] > x["start"])  # of at most one
        alone = F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))
        return F.when(x["free"], F.struct(
            F.struct(a["covered"].alias("covered"), F.when(x["start"] >= a["covered"], alone).otherwise(none).alias("waits")).alias("state"),
            a["waits"].alias("out"))).otherwise(F.struct(
                F.struct(F.greatest(a["covered"], x["end"]).alias("covered"), F.when(hit, none).otherwise(a["waits"]).alias("waits")).alias("state"),
                none.alias("out")))

    return F.when((F.size(taken) == 0) | (F.size(found) == 0), found).otherwise(once(both, lambda items: _emitted(items, zero, PLACE, step)))


def other_tokens(text: Column, base: Column) -> Column:
    """Identifier-like runs and tokens outside all base spans and one another: seeds of kind `secret`, else of kind null."""
    runs = F.when(text.rlike(r"[0-9][A-Za-z]*[\x20)./-]"), once(F.filter(
        _matches(text, RUN), lambda m: ~m["value"].rlike("[0-9a-f]{32}")), lambda found: _apart(found, base))).otherwise(
            F.array().cast(f"array<{PLACE}>"))
    tokens = F.filter(_matches(text, TOKEN), lambda m: F.char_length(m["value"]) >= MIN_CHARS)
    taken = lambda joined: F.concat(F.transform(base, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))), joined)
    found = once(runs, lambda joined: once(tokens, lambda some: F.concat(joined, once(taken(joined), lambda t: _apart(some, t)))))
    spans = F.transform(found, lambda m: F.struct(
        F.when(m["value"].rlike(SECRET), F.lit("secret")).alias("kind"), m["start"].alias("start"),
        m["end"].alias("end"), m["value"].alias("value"))).cast(SPAN)
    return F.when(text.rlike("[0-9@]"), spans).otherwise(F.array().cast(SPAN))


def _instance(value: Column) -> Column:
    """A value's node: long numbers by their digits alone, others in lower case."""
    digits = _digits(value)
    return F.when((F.char_length(digits) >= 8) & ~value.rlike("[A-Za-z@]") & ~value.rlike(r"^[0-9]+(\.[0-9]+){3}$"), digits).otherwise(F.lower(value))


def _node(value: Column, patterns: Column) -> Column:
    """A value's instance; a short one's is bound to its context."""
    short = ~F.contains(value, F.lit("@")) & (F.char_length(_digits(value)) < MIN_DIGITS)
    return F.when(short, F.concat_ws("\n", F.lower(value), F.xxhash64(patterns).cast("string"))).otherwise(_instance(value))


def _pieces(side: Column) -> Column:
    """Lower-case pieces of a context; digits are all alike."""
    return F.filter(F.split(F.regexp_replace(F.lower(side), "[0-9]+", "0"), r"[\x20\x09-\x0D]+"), lambda p: p != "")


def _with_context(text: Column, spans: Column) -> Column:
    """Occurrences: a span's kind, place, instance and the patterns around it."""
    return F.when(F.size(spans) == 0, F.array()).otherwise(once(_chunks(text), lambda chunks: _in_context(chunks, spans)))


def _in_context(chunks: Column, spans: Column) -> Column:

    def occurrence(s: Column) -> Column:
        left = _near(chunks, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)), s["start"])
        right = _near(chunks, s["end"], s["end"] + CONTEXT_CHARS)
        patterns = once(_pieces(left), lambda before: once(_pieces(right), lambda after: F.filter(F.array(
            F.concat(F.lit("L1 "), F.get(before, F.size(before) - 1)),
            F.concat(F.lit("L2 "), F.get(before, F.size(before) - 2), F.lit(" "), F.get(before, F.size(before) - 1)),
            F.concat(F.lit("L3 "), F.get(before, F.size(before) - 3), F.lit(" "), F.get(before, F.size(before) - 2),
                     F.lit(" "), F.get(before, F.size(before) - 1)),
            F.concat(F.lit("R1 "), F.get(after, F.lit(0))),
            F.concat(F.lit("LR "), F.get(before, F.size(before) - 1), F.lit(" _ "), F.get(after, F.lit(0))),
        ), lambda p: p.isNotNull())))
        return once(patterns, lambda p: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["value"].alias("value"), _node(s["value"], p).alias("instance"), p.alias("patterns")))

    return F.transform(spans, occurrence)


def occurrences(documents: DataFrame) -> DataFrame:
    """One row per document: `_rid`, doc_id, text_key, base spans, and all occurrences with their patterns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"), text.alias("_text"))
    rows = rows.withColumn("base", base_spans(F.col("_text")))
    rows = rows.withColumn("other", other_tokens(F.col("_text"), F.col("base")))
    rows = rows.withColumn("found", _with_context(F.col("_text"), F.concat("base", "other")))
    return rows.select(F.monotonically_increasing_id().alias("_rid"), "doc_id", "text_key", "base", "found")


def trusted_instances(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(instance, score) of trusted instances that aren't seeds; found: rows of occurrences."""
    seeds = found.where("kind is not null").select("instance").distinct()
    edges = written(found.select("instance", F.explode("patterns").alias("pattern")).distinct(), "pii-graph")
    seeds = written(seeds.withColumn("score", F.lit(1.0)), "pii-seeds")
    trusted, known = seeds, None
    for _ in range(rounds):
        weight = edges.join(trusted, "instance", "left").groupBy("pattern").agg(
            F.sum(F.coalesce("score", F.lit(0.0))).alias("good"), F.count(F.lit(1)).alias("n"))
        patterns = weight.where(F.col("good") >= MIN_SUPPORT).withColumn(
            "confidence", F.round(F.col("good") / (F.col("n") + 1), 6)).where(F.col("confidence") >= MIN_CONFIDENCE)
        scored = edges.join(patterns, "pattern").groupBy("instance").agg(
            F.round(1 - F.exp(F.sum(F.log1p(-F.col("confidence")))), 6).alias("score")).where(F.col("score") >= MIN_SCORE)
        fresh = written(scored.join(seeds.select("instance"), "instance", "left_anti"), "pii-trusted")
        # no instance is lost and no score falls from round to round, so equal numbers and sums mean equal instances and scores
        found_now = fresh.agg(F.count(F.lit(1)), F.sum(F.round(F.col("score") * 1_000_000).cast("long"))).first()
        if found_now == known:
            break
        known, trusted = found_now, seeds.unionByName(fresh)
    else:
        logging.getLogger(__name__).warning("trusted instances still changed in round %d, the last one", rounds)
    return fresh


def find(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document row: doc_id, text_key, `base` and `spans` (kind, start, end, value).

    `spans`: base spans by kind as listed and start, then found ones (`id`, `secret`) by kind and start.
    """
    rows = written(occurrences(documents), "pii-occurrences")
    flat = rows.select("_rid", F.inline("found"))
    trusted = trusted_instances(flat.select("kind", "instance", "patterns"), rounds).select("instance").withColumn("hit", F.lit(True))
    others = flat.where(f"kind is null or kind not in {KINDS!r}")
    added = others.join(trusted, "instance", "left").where("kind is not null or hit").select(
        "_rid", F.struct(F.coalesce("kind", F.lit("id")).alias("kind"), "start", "end", "value").alias("span"))
    added = added.groupBy(F.col("_rid").alias("_rid2")).agg(F.sort_array(F.collect_list("span")).alias("added"))  # one text's spans
    joined = rows.join(added, rows["_rid"] == added["_rid2"], "left")
    return joined.select("doc_id", "text_key", "base", F.concat("base", F.coalesce("added", F.array().cast(SPAN))).alias("spans"))


def digest(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _masked(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by <KIND> of its first span."""
    size = F.char_length(text).cast("long")
    order = F.concat(F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))),
                     F.array(F.struct(size.alias("start"), size.alias("end"), F.lit(None).cast("string").alias("kind"))))

    def written_out(chunks: Column) -> Column:
        def step(at: Column, s: Column) -> Column:
            tag = F.coalesce(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")), F.lit(""))
            return F.struct(F.greatest(at, s["end"]).alias("state"), F.when(s["start"] < at, F.array().cast("array<string>")).otherwise(
                F.array(_part(chunks, at, s["start"]), tag)).alias("out"))

        return F.array_join(once(order, lambda items: _emitted(items, F.lit(0).cast("long"), "string", step)), "")

    return once(_chunks(text), written_out)


def mask(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """`documents` (same columns) with each span replaced by its kind in angle brackets, `n_chars` counted anew.

    Only texts that can hold a span are joined with their spans; the rest pass through.
    """
    spans = find(documents, rounds).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("_doc2"), F.col("text_key").alias("_key2"), F.col("spans").alias("_spans"))
    spans = spans.dropDuplicates(["_doc2", "_key2"])
    text = F.col("text").cast("string")
    rows = documents.select(as_record(documents), F.col("doc_id").alias("_doc"), text.alias("_text"), F.xxhash64(text).alias("_key"))
    can = F.coalesce(F.col("_text").rlike("[0-9@]"), F.lit(False))
    joined = rows.where(can).join(spans, (F.col("_key") == F.col("_key2")) & F.col("_doc").eqNullSafe(F.col("_doc2")), "left")
    hit = F.col("_spans").isNotNull()
    new = joined.select("_row", F.when(hit, _masked(F.col("_text"), F.col("_spans"))).otherwise(F.col("_text")).alias("text"), hit.alias("_changed"))
    plain = rows.where(~can).select("_row", F.col("_text").alias("text"), F.lit(False).alias("_changed"))
    return with_text(plain.unionByName(new), documents)

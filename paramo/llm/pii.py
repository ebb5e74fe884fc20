"""Operator 7, personal data: base patterns, and bootstrapped contextual extraction.

Four kinds are found by their form (:data:`KINDS`).  These seeds teach
lexical patterns: the two words left of an identifier, the word on either
side, and, more general, the one word left, or the second one with any word
between.  Words are taken without case, signs and what digits they hold, so
"No. 7:" and "no 9" are one context.  Candidates are identifier-like strings outside the base spans.  On the
graph of patterns and the values seen in them, Spark scores in rounds:

* a pattern's confidence for a kind is the scores of that kind's values in it
  over those of all its values, unlabelled ones counting ``UNKNOWN`` each; it
  is trusted from ``CONFIDENT`` on, with at least ``SUPPORT`` labelled values,
  a general one with at least ``BROAD`` (in prose, five values of one kind
  stand behind some common word by chance);
* a value's score is the chance that not all trusted patterns it occurs in
  are wrong; from ``CONFIDENT`` on the value is labelled and teaches in turn.

It goes on until no value is labelled anew.  All occurrences of a labelled
value are then spans too, seeds in writings that the base patterns miss among
them, and where it is a part of a longer row of digits; of labelled strings that overlap
the likeliest stays.  A seed that was found as two kinds gives a span of each, as its form does.  The texts are read once; all later work is on the
matches, which are written to the shared folder.

Main path: DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paramo.llm.common import highest_before, let, pick, pieces_at, running, store

# Each base pattern starts where a run of its first characters starts, or right after a match (\G): elsewhere in
# the run it could only match if it did at the start.  That, and possessive repeats, keep long runs from
# costing the square of their length.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Identifier-like: grouped digits, or a token of letters, digits and signs that holds a digit or an @, the first of them within
#: 128 characters of a place where a token may start; a row of more than 512 digits is several.  So no start looks farther ahead.
CANDIDATE = r"(?:(?<![0-9A-Za-z])|\G)(?:[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){1,512}+(?![0-9A-Za-z@])|(?=[A-Za-z._%+-]{0,128}+[0-9@])[A-Za-z0-9](?:[A-Za-z0-9._%+@-]*[A-Za-z0-9])?)"
KINDS = ("email", "ip", "card", "phone")
#: Letters and digits that a candidate has at least, digits (or an @) among them; labelled values that a trusted pattern has; its confidence; what an unlabelled value counts.
SIGNS, DIGITS, SUPPORT, CONFIDENT, UNKNOWN = 7, 4, 5, 0.9, 0.1
#: Labelled values that a general pattern has at least; the mark that such a pattern ends with.
BROAD, GENERAL = 20, " ~"
#: Digits of neighbouring runs that are looked up together, at most: as many as the longest kind has.
LONGEST = 19

#: An IP that passes its test, alone.
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
WHOLE_IP = rf"\A{OCTET}(?:\.{OCTET}){{3}}\z"

SPAN = "struct<start: int, rank: int, end: int, value: string>"
PART = "struct<start: int, rank: int, end: int, value: string, of: bigint>"
NONE = f"cast(array() as array<{SPAN}>)"


def located(text: Column, regex: str, rank: int) -> Column:
    """Leftmost non-overlapping matches as ``(start, rank, end, value)``, in code points, end exclusive."""
    matches = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    pairs = F.filter(F.arrays_zip(F.split(text, regex, -1).alias("gap"), matches.alias("value")), lambda p: p["value"].isNotNull())

    def placed(found: Column) -> Column:
        at = running(F.transform(found, lambda p: F.length(p["gap"]) + F.length(p["value"])))
        return F.zip_with(found, at, lambda p, x: F.struct((x + F.length(p["gap"])).alias("start"), F.lit(rank).alias("rank"),
                                                           (x + F.length(p["gap"]) + F.length(p["value"])).alias("end"), p["value"].alias("value")))

    return F.when(F.size(matches) > 0, let(pairs, placed)).otherwise(F.expr(NONE))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    back = F.reverse(digits)
    summed = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0),
                         lambda s, i: s + F.element_at(F.array(*[F.lit(x) for x in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                                                       F.substr(back, i, F.lit(1)).cast("int") + F.when(i % 2 == 0, 10).otherwise(0) + 1))
    return summed % 10 == 0


def base_spans(text: Column) -> Column:
    """All spans of the four kinds that pass their tests, by start and kind."""
    none = F.expr(NONE)
    has_digit = F.rlike(text, F.lit("[0-9]"))
    part = lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255
    number = lambda s, least, most: F.length(digits_of(s["value"])).between(least, most)
    emails = F.when(F.contains(text, F.lit("@")), located(text, EMAIL, 0)).otherwise(none)
    ips = F.when(has_digit, F.filter(located(text, IP, 1), lambda s: F.forall(F.split(s["value"], r"\."), part))).otherwise(none)
    cards = F.when(has_digit, F.filter(located(text, CARD, 2), lambda s: F.when(number(s, 14, 19), luhn(digits_of(s["value"]))).otherwise(False))).otherwise(none)
    phones = F.when(F.contains(text, F.lit("+")), F.filter(located(text, PHONE, 3), lambda s: number(s, 10, 15))).otherwise(none)
    return F.array_sort(F.concat(emails, ips, cards, phones))


def around(text: Column, base: Column) -> Column:
    """The text with line breaks in place of its base spans, so that the pieces between them are searched, at their places."""
    def masked(spans: Column) -> Column:
        upto = highest_before(F.transform(spans, lambda b: b["end"]))
        # of each span: the text since the spans before it, and line breaks for what they leave of it
        cuts = F.zip_with(spans, upto, lambda b, at: F.struct(F.least(at, b["start"]).alias("start"), b["start"].alias("end"), F.greatest(b["end"] - F.greatest(at, b["start"]), F.lit(0)).alias("blank"), (b["start"] > at).alias("any")))

        def filled(c: Column) -> Column:
            gaps = F.zip_with(pieces_at(text, c), c, lambda piece, x: F.concat(F.when(x["any"], piece).otherwise(F.lit("")), F.repeat(F.lit("\n"), x["blank"])))
            return F.concat(F.array_join(gaps, ""), F.substr(text, F.array_max(F.transform(spans, lambda b: b["end"])) + 1, F.length(text)))

        return let(cuts, filled)

    return F.when(F.size(base) > 0, let(base, masked)).otherwise(text)


def candidate_spans(gaps: Column) -> Column:
    """Identifier-like strings of the text :func:`around` the base spans, as ``(start, rank, end, value, of)``.

    Rank -1 are strings as they stand.  Of one that joins several runs of
    digits come also the runs that are long enough alone (rank -2), and
    neighbouring runs of together ``SIGNS`` to ``LONGEST`` digits (rank -3),
    which are looked up among the labelled values but teach nothing.  ``of``
    stands for the joined value."""
    found = F.when(F.rlike(gaps, F.lit("[0-9@]")), located(gaps, CANDIDATE, -1)).otherwise(F.expr(NONE))

    def wanted(s: Column) -> Column:
        return (F.length(signs_of(s["value"])) >= SIGNS) & ((F.length(digits_of(s["value"])) >= DIGITS) | F.contains(s["value"], F.lit("@")))

    def part(s: Column, first: Column, last: Column) -> Column:
        rank = F.when(first["start"] == last["start"], -2).otherwise(-3)
        value = F.substr(s["value"], first["start"] + 1, last["end"] - first["start"])
        return F.struct((s["start"] + first["start"]).alias("start"), rank.alias("rank"), (s["start"] + last["end"]).alias("end"), value.alias("value"), s["of"].alias("of"))

    def parts(s: Column) -> Column:
        # lambdas bind the runs, which would be found anew for each of them otherwise
        runs = F.array(located(s["value"], "[0-9]+", 0))
        every = F.flatten(F.flatten(F.transform(runs, lambda r: F.transform(r, lambda first, i: F.transform(F.slice(r, i + 1, F.lit(LONGEST)), lambda last: part(s, first, last))))))
        some = F.filter(every, lambda x: (F.length(digits_of(x["value"])).between(SIGNS, LONGEST) | ((x["rank"] == -2) & (x["end"] - x["start"] >= SIGNS)))
                        & ~((x["start"] <= s["start"] + 1) & (x["end"] == s["end"])))  # which would be the whole, perhaps after a + or (
        return F.when(F.rlike(s["value"], F.lit("[0-9][^0-9]+[0-9]")) & ~F.rlike(s["value"], F.lit("[A-Za-z@]")), some).otherwise(F.array().cast(f"array<{PART}>"))

    whole = F.transform(F.filter(found, wanted), lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["value"].alias("value"), F.xxhash64(normal(s["value"])).alias("of")))
    return F.flatten(F.transform(whole, lambda s: F.concat(F.array(s), parts(s))))


def signs_of(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9A-Za-z@]", "")


def normal(value: Column) -> Column:
    """What makes two writings of an identifier one value: its letters and digits, lower-cased.

    An IP keeps its dots and what holds an @ all its signs: there they tell
    values apart, so plain digits are never an IP's second writing."""
    return F.lower(F.when(F.contains(value, F.lit("@")) | F.rlike(value, F.lit(WHOLE_IP)), value).otherwise(signs_of(value)))


def sides(text: Column, spans: Column) -> Column:
    """``(left, right)`` of each span: up to 64 characters before it and 48 after."""
    def told(s: Column) -> Column:
        left = pieces_at(text, F.transform(s, lambda x: F.struct(F.greatest(x["start"] - 64, F.lit(0)).alias("start"), x["start"].alias("end"))))
        right = pieces_at(text, F.transform(s, lambda x: F.struct(x["end"].alias("start"), (x["end"] + 48).alias("end"))))
        return F.arrays_zip(left.alias("left"), right.alias("right"))

    return F.when(F.size(spans) > 0, let(spans, told)).otherwise(F.array().cast("array<struct<left: string, right: string>>"))


def patterns(side: Column) -> Column:
    """The lexical patterns of a context: ``a b _`` (two words to the left) and ``b _ c`` (one on either side), and the general ``b _`` and ``a * _``.

    Words are lower-cased, digits are 0, and signs around a word are left out."""
    def found(left: Column, right: Column) -> Column:
        word = lambda w: F.regexp_replace(F.regexp_replace(F.lower(w), "[0-9]+", "0"), r"^[^\p{L}0-9]+|[^\p{L}0-9]+$", "")
        before = word(F.regexp_extract(left, r"(?:\A|\s)(\S{1,24})\s+\S{1,24}\s*\z", 1))
        near = word(F.regexp_extract(left, r"(?:\A|\s)(\S{1,24})\s*\z", 1))
        after = word(F.regexp_extract(right, r"\A\s*(\S{1,24})(?:\s|\z)", 1))
        return let(F.struct(before.alias("a"), near.alias("b"), after.alias("c")), lambda w: F.filter(F.array(
            F.when((w["a"] != "") & (w["b"] != ""), F.concat(w["a"], F.lit(" "), w["b"], F.lit(" _"))),
            F.when((w["b"] != "") & (w["c"] != ""), F.concat(w["b"], F.lit(" _ "), w["c"])),
            F.when(w["b"] != "", F.concat(w["b"], F.lit(" _" + GENERAL))),
            F.when(w["a"] != "", F.concat(w["a"], F.lit(" * _" + GENERAL)))), lambda p: p.isNotNull()))

    return found(side["left"], side["right"])


def bootstrapped(edges: DataFrame, seeds: DataFrame, units: DataFrame) -> DataFrame:
    """``(value, rank, score)`` of the seeds and of the values that trusted patterns label, from ``edges(pattern, value)``,
    ``seeds(value, rank)`` and ``units(pattern, of)``, all distinct: a string and its parts are one unit, of which one at most is an identifier's.

    Stops when a round labels nothing new; each round labels a value at
    least, in practice the rounds are few.  Only sums by pattern and by value
    are shuffled, combined before."""
    labels = store(seeds.withColumn("score", F.lit(1.0)), "pii-labels")
    size = store(units.groupBy("pattern").agg(F.count(F.lit(1)).alias("size")), "pii-patterns")
    while True:
        told = edges.join(labels, "value").groupBy("pattern", "rank").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("labelled"))
        all_kinds = told.groupBy("pattern").agg(F.sum("score").alias("all_scores"), F.sum("labelled").alias("all_labelled"))
        against = F.col("all_scores") + UNKNOWN * F.greatest(F.col("size") - F.col("all_labelled"), F.lit(0))
        enough = F.when(F.col("pattern").endswith(GENERAL), BROAD).otherwise(SUPPORT)
        trusted = (told.where(F.col("labelled") >= enough).join(all_kinds, "pattern").join(size, "pattern")
                   .select("pattern", "rank", (F.col("score") / against).alias("confidence")).where(F.col("confidence") >= CONFIDENT))
        trusted = store(trusted, "pii-trusted")
        doubt = edges.join(trusted, "pattern").groupBy("value", "rank").agg(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))).alias("doubt"))
        best = doubt.groupBy("value").agg(F.min(F.struct("doubt", "rank")).alias("best")).select("value", F.col("best.rank").alias("rank"), (1 - F.exp("best.doubt")).alias("score"))
        new = store(best.where(F.col("score") >= CONFIDENT).join(labels, "value", "left_anti"), "pii-new")
        if new.isEmpty():
            return labels.select("value", "rank", "score")
        labels = store(labels.unionByName(new), "pii-labels")


def likeliest(told: Column) -> Column:
    """The spans in their order, without those that overlap an earlier one; one place keeps all its kinds."""
    def add(kept: Column, x: Column) -> Column:
        s = x["span"]
        clash = F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]) & ((k["start"] != s["start"]) | (k["end"] != s["end"])))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(s)))

    return F.aggregate(F.array_sort(told), F.expr(NONE), add)


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, base, spans)`` for every row of ``docs``: arrays of ``(start, rank, end, value)``, by start and kind.

    ``base`` are the spans found by form, ``spans`` those and the discovered
    ones; ``rank`` counts in KINDS.  Null texts have none; repeated rows get
    their row each; an empty table gives an empty result.  Whole texts are
    read; other columns are not."""
    rows = pick(docs, id=key, txt=text).withColumn("txt", F.coalesce("txt", F.lit("")))
    found = rows.withColumn("base", base_spans(F.col("txt"))).withColumn("gaps", around(F.col("txt"), F.col("base"))).withColumn("near", candidate_spans(F.col("gaps")))

    case = "struct<start: int, rank: int, end: int, value: string, of: bigint>"
    base_cases = F.transform("base", lambda s: F.struct(s["start"], s["rank"], s["end"], normal(s["value"]).alias("value"), F.xxhash64(normal(s["value"])).alias("of")).cast(case))
    near_cases = F.transform(F.filter("near", lambda s: s["rank"] >= -2), lambda s: F.struct(s["start"], s["rank"], s["end"], normal(s["value"]).alias("value"), s["of"].alias("of")).cast(case))

    def with_patterns(cases: Column) -> Column:
        return F.zip_with(cases, sides(F.col("txt"), cases), lambda s, side: F.struct(s["rank"].alias("rank"), s["value"].alias("value"), s["of"].alias("of"), patterns(side).alias("patterns")))

    seen = let(F.concat(base_cases, near_cases), with_patterns)
    # the number tells rows apart that have no key or share one; it is fixed once it is written
    found = store(found.select(F.monotonically_increasing_id().alias("row"), "id", "base", "near", seen.alias("seen")), "pii-matches")
    cases = found.select(F.explode("seen").alias("s")).select("s.*")
    seen_in = cases.select(F.explode("patterns").alias("pattern"), "value", "of")
    edges = store(seen_in.select("pattern", "value").distinct(), "pii-edges")
    seeds = cases.where("rank >= 0").select("value", "rank").distinct()
    near = found.where(F.size("near") > 0).select("row", F.explode("near").alias("s")).withColumn("value", normal(F.col("s.value")))
    # most seeds have no second writing: only the labels of values that are candidates somewhere meet them
    labelled = bootstrapped(edges, seeds, seen_in.select("pattern", "of").distinct()).join(near.select("value").distinct(), "value", "left_semi")
    labelled = store(labelled, "pii-discovered")
    wide = edges.join(labelled.select("value").distinct(), "value").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    labelled = store(labelled.join(wide, "value", "left"), "pii-labelled")
    # the best score first, then the value of most patterns, then what a kind's length allows, then the longest
    order = [-F.col("score"), -F.coalesce("n", F.lit(0)), F.length(digits_of(F.col("value"))) > LONGEST, F.col("s.start") - F.col("s.end")]
    told = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.struct("s.start", "rank", "s.end", "s.value").alias("span"))
    taken = near.join(labelled, "value").groupBy("row", "s.of").agg(likeliest(F.collect_list(told)).alias("more"))
    more = taken.groupBy("row").agg(F.flatten(F.collect_list("more")).alias("more"))
    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return found.join(more, "row", "left").select(F.col("id").alias(key), "base", every.alias("spans"))

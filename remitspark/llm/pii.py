"""Personal data by weak supervision: emails, IP addresses, payment cards and phone numbers.

Strict patterns give the base spans, which always stay. Wider patterns give candidates, and labelers
vote on each: the strict pattern, a shape or checksum, a gazetteer (top-level domains, address ranges,
issuer prefixes, country codes) and cue words before it. A vote is 1 (personal), -1 (not) or 0. Nobody
says which labelers are right: expectation-maximisation over the counts of vote patterns, at most 81 a
kind, estimates what a vote of each is worth, and so a probability for every candidate; silence is worth
nothing. With these as labels a naive Bayes classifier of spans is trained on what the labelers don't
see: the span's shape and length, the word before and the sign after it, and the votes as a whole.
A candidate with a probability of at least ``SURE`` is added, unless it overlaps a base span or a span
before it that the classifier takes.

DataFrame functions do all of it. The texts are read once; what is kept of them is a table of spans.
Positions are running sums of the lengths between matches, in blocks, so a text with a million spans is
not quadratic. Matches are leftmost and don't overlap; the patterns have no nested choices, so no text makes
them slow or deep. Spans are in code points, ends exclusive.

Defined results: a null text counts as empty and has no spans; null ids stay null, every row is a row
of its own; an empty table gives no rows. Texts of any length are searched whole. Other columns are
passed on as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame, functions as F

from remitspark.llm.common import let, stored

SURE = 0.9
#: Code points before and after a candidate that are looked at.
BEFORE, AFTER = 40, 12
BINS = 1024
ROUNDS, CLOSE = 30, 1e-3
#: Elements of a block of running sums.
BLOCK = 512
LABELERS = 4
#: Votes that each labeler is assumed to have given before any are seen, by class and vote.
ASSUMED = {0: {-1: 4.0, 1: 1.0}, 1: {-1: 1.0, 1: 4.0}}
#: A position after all texts.
MOST = 1 << 62
FEATURES = 5

#: The base patterns, written so that they need no backtracking. ``\\G`` is the end of the match before.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Domains at the top level, two letters for countries aside.
DOMAINS = "com org net edu gov mil int info biz name pro io ai app dev cloud online site shop blog email museum coop aero jobs mobi travel tel cat asia post xxx"
#: Country codes of telephone numbers.
COUNTRIES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
#: Words that tell what a number or name is.
CUES = {
    "email": "e-?mails?|courriel|correo|mailto|contact|kontakt|contacto|write to|reach",
    "ip": "ips?|ipv[46]|host|server|servidor|serveur|addr|address|adresse|ping|login from|client|gateway|dns",
    "card": "cards?|carte|tarjeta|karte|kreditkarte|visa|mastercard|amex|credit|debit|payment|cc|pan",
    "phone": "phones?|tel|telephone|telefon|teléfono|téléphone|mobile|handy|móvil|portable|call|fax|whatsapp|sms|cell|contact",
}
COUNTER_CUES = "version|versions|v|release|section|chapter|isbn|issn|doi|page|pages|fig|figure|table|order|invoice|ref|id|no|nr|build|serial|price|total|year|line|item"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the check digit of a number is right; other signs don't count."""

    def add(total: Column, digit: Column, at: Column) -> Column:
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(at % 2 == 1, twice).otherwise(digit)

    def sums(digits: Column) -> Column:
        valued = F.transform(digits, lambda digit, at: add(F.lit(0), digit.cast("int"), at))
        return F.aggregate(valued, F.lit(0), lambda total, x: total + x) % 10 == 0

    return sums(F.reverse(F.regexp_extract_all(text, F.lit("[0-9]"), 0)))


def _is_card(text: Column) -> Column:
    return F.when(F.length(_digits(text)).between(14, 19), luhn(text)).otherwise(F.lit(False))


def _is_phone(text: Column) -> Column:
    return F.length(_digits(text)).between(10, 15)


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    return (vote if no is None else vote.when(no, -1)).otherwise(0)


def _any_of(words: str) -> str:
    return f"(?:{words.replace(' ', '|')})"


@dataclass(frozen=True)
class Kind:
    """Patterns of a kind, what a text must contain for them, which matches hold, and what labelers say of a candidate."""

    name: str
    base: str
    needs: str
    holds: Callable[[Column], Column]
    wide: str
    shape: Callable[[Column], Column]
    gazetteer: Callable[[Column], Column]

    def votes(self, text: Column, before: Column) -> list[Column]:
        cue = F.concat(F.lit(r"(?i)(?<![\p{L}0-9])(?:"), F.lit(CUES[self.name]), F.lit(r")[^\p{L}0-9]{0,4}(?:[\p{L}]{1,6}[^\p{L}0-9]{1,3})?$"))
        against = F.lit(rf"(?i)(?<![\p{{L}}0-9])(?:{COUNTER_CUES})[^\p{{L}}0-9]{{0,4}}$")
        strict = F.regexp_like(text, F.lit(rf"^(?:{self.base})$")) & self.holds(text)
        return [_vote(strict), self.shape(text), self.gazetteer(text), _vote(F.regexp_like(before, cue), F.regexp_like(before, against))]


def _like(text: Column, pattern: str) -> Column:
    return F.regexp_like(text, F.lit(pattern))


KINDS = (
    Kind(
        "email",
        EMAIL,
        "[@(\\[{]",
        lambda text: F.lit(True),
        # Letters of any script, and the signs written out in brackets.
        r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+\x20?(?:@|[\[({]\x20?(?i:at)\x20?[\])}])\x20?[\p{L}\p{N}-]{1,63}+"
        r"(?:\x20?(?:\.|[\[({]\x20?(?i:dot)\x20?[\])}])\x20?[\p{L}\p{N}-]{1,63}+)++",
        lambda text: _vote(_like(text, r"\.\p{L}{2,24}$|(?i)dot\x20?[\])}]\x20?\p{L}{2,24}$"), _like(text, r"(?:^|@)[._-]|\.\.|[0-9]$")),
        lambda text: _vote(_like(text, rf"(?i)[.\])}}]\x20?(?:{_any_of(DOMAINS)}|[a-z]{{2}})$"), _like(text, r"\p{L}{25,}$")),
    ),
    Kind(
        "ip",
        IP,
        r"[0-9]\.[0-9]|:[0-9A-Fa-f]*:",
        lambda text: _like(text, rf"^{BYTE}(?:\.{BYTE}){{3}}$"),
        r"(?<![\p{L}0-9.:])(?:[0-9]{1,6}+(?:\.[0-9]{1,6}+){3}|(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4})(?![\p{L}0-9:]|\.[0-9])",
        lambda text: _vote(
            _like(text, rf"^{BYTE}(?:\.{BYTE}){{3}}$|^(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}$"),
            _like(text, r"^[0-9]{1,2}(?::[0-9]{2}){1,2}$|[0-9]{4,}\."),
        ),
        lambda text: _vote(_like(text, r"^(?:1[0-9]{1,2}|2[0-4][0-9]|[2-9][0-9]|25[0-5])\.|^(?:2[0-9A-Fa-f]{3}|fe80|fd)"), _like(text, r"^[0-9]\.[0-9]\.")),
    ),
    Kind(
        "card",
        CARD,
        r"[0-9][\x20-]?[0-9]",
        _is_card,
        r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){12,18}(?![0-9])",
        lambda text: F.when(luhn(text), 1).otherwise(-1),
        lambda text: _vote(
            _like(_digits(text), r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|65|64[4-9]|62|81)"), _like(_digits(text), r"^0|^([0-9])\1+$")
        ),
    ),
    Kind(
        "phone",
        PHONE,
        r"[0-9][\x20().0-9/-]{4}",
        _is_phone,
        r"(?<![\p{L}0-9+.])(?:\+|00|\()?[0-9][\x20()./0-9-]{5,20}[0-9](?![\p{L}0-9])",
        lambda text: _vote(
            F.length(_digits(text)).between(10, 13) & _like(text, r"^[+(]|^00|[0-9][\x20./-]+[0-9]"), ~F.length(_digits(text)).between(7, 15)
        ),
        lambda text: _vote(
            _like(text, rf"^(?:\+|00)\x20?{_any_of(COUNTRIES)}") | _like(text, r"^\(?[2-9][0-9]{2}\)?[\x20.-][2-9][0-9]{2}[\x20.-][0-9]{4}$"),
            _like(text, r"^(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.]|^[0-9]+$"),
        ),
    ),
)


def _plain(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running results of a short array, with the start value before them."""
    return F.aggregate(values, F.array(start), lambda made, x: F.array_append(made, step(F.element_at(made, -1), x)))


def running(values: Column, step: Callable[[Column, Column], Column], start: int) -> Column:
    """Running results of an array of longs, block by block; ``step`` must be associative, ``start`` its neutral element."""
    first = F.lit(start).cast("long")

    def cut(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda k: F.slice(v, k * BLOCK + 1, BLOCK))

    def joined(blocks: Column) -> Column:
        before = _plain(F.transform(blocks, lambda block: F.aggregate(block, first, lambda a, b: step(a, b))), first, step)
        made = F.zip_with(blocks, before, lambda block, made: F.when(block.isNotNull(), F.slice(_plain(block, made, step), 2, BLOCK)))
        return F.flatten(F.filter(made, lambda block: block.isNotNull()))

    some = lambda v: F.when(F.size(v) > 0, let(cut(v), joined)).otherwise(F.array().cast("array<long>"))
    return let(values, some)


def _matches(text: Column, pattern: str, needs: str) -> Column:
    """The matches of a pattern: start, end, word, before, after."""

    def spans(found: Column, pieces: Column, ends: Column) -> Column:
        def span(word: Column, k: Column) -> Column:
            end = F.get(ends, k)
            before = F.right(F.get(pieces, k), F.lit(BEFORE))
            after = F.left(F.get(pieces, k + 1), F.lit(AFTER))
            return F.struct((end - F.length(word)).alias("start"), end.alias("end"), word.alias("word"), before.alias("before"), after.alias("after"))

        return F.transform(found, span)

    def placed(found: Column, pieces: Column) -> Column:
        widths = F.transform(found, lambda word, k: (F.length(F.get(pieces, k)) + F.length(word)).cast("long"))
        return let(running(widths, lambda a, b: a + b, 0), lambda ends: spans(found, pieces, ends))

    none = F.array().cast("array<string>")
    found = F.when(_like(text, needs), F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(none)
    split = lambda found: F.when(F.size(found) > 0, F.split(text, pattern, -1)).otherwise(none)
    return let(found, lambda found: let(split(found), lambda pieces: placed(found, pieces)))


def _features(word: Column, before: Column, after: Column, votes: Column) -> Column:
    shape = F.regexp_replace(F.regexp_replace(word, "[0-9]+", "9"), r"\p{L}+", "a")
    last = F.lower(F.regexp_extract(before, r"(\p{L}+)[^\p{L}]*$", 1))
    values = [shape, F.length(word).cast("string"), last, F.left(after, F.lit(1)), F.array_join(votes.cast("array<string>"), " ")]
    bins = [F.pmod(F.xxhash64(F.lit(slot), value), F.lit(BINS)).cast("int") for slot, value in enumerate(values)]
    return F.array(*bins)


def _place(x: Column, k: int) -> list[Column]:
    return [x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end")]


def _base(k: int, kind: Kind) -> Column:
    held = F.filter(_matches(F.col("text"), kind.base, kind.needs), lambda x: kind.holds(x["word"]))
    return F.transform(held, lambda x: F.struct(*_place(x, k)))


def _candidates(k: int, kind: Kind) -> Column:
    def judged(x: Column, votes: Column) -> Column:
        return F.struct(*_place(x, k), votes.alias("votes"), _features(x["word"], x["before"], x["after"], votes).alias("features"))

    wide = _matches(F.col("text"), kind.wide, kind.needs)
    return F.transform(wide, lambda x: let(F.array(*kind.votes(x["word"], x["before"])), lambda votes: judged(x, votes)))


def _free(base: Column, found: Column) -> Column:
    """The candidates with ``free``: whether one overlaps no base span. Others stay if they are strict matches."""
    most, zero = F.lit(MOST).cast("long"), F.lit(0).cast("long")

    def marked(both: Column, ends: Column, starts: Column) -> Column:
        def judged(x: Column, i: Column) -> Column:  # there is no element -1
            free = (F.coalesce(F.get(ends, i - 1), zero) <= x["start"]) & (F.coalesce(F.get(starts, i + 1), most) >= x["end"])
            return F.struct(x["at"].alias("at"), free.alias("free"))

        return F.filter(F.transform(both, judged), lambda y: y["at"] > 0)

    def with_ends(both: Column) -> Column:
        ends = running(F.transform(both, lambda x: F.when(x["at"] == 0, x["end"]).otherwise(zero)), lambda a, b: F.greatest(a, b), 0)
        starts = F.reverse(F.transform(both, lambda x: F.when(x["at"] == 0, x["start"]).otherwise(most)))
        starts = F.reverse(running(starts, lambda a, b: F.least(a, b), MOST))
        return let(ends, lambda ends: let(starts, lambda starts: marked(both, ends, starts)))

    def flagged(found: Column) -> Column:
        bases = F.transform(base, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(0).alias("at")))
        places = F.transform(found, lambda x, i: F.struct(x["start"].alias("start"), x["end"].alias("end"), (i + 1).alias("at")))
        marks = let(F.array_sort(F.concat(bases, places)), with_ends)
        made = F.transform(marks, lambda y: F.get(found, y["at"] - 1).withField("free", y["free"]))
        return F.filter(made, lambda x: x["free"] | (F.get(x["votes"], F.lit(0)) == 1))

    return let(found, flagged)


def spans_of(texts: DataFrame) -> DataFrame:
    """The rows without ``text``, with ``base`` (kind, start, end) and ``found``, the candidates with votes and features."""
    base = F.array_sort(F.concat(*[_base(k, kind) for k, kind in enumerate(KINDS)]))
    found = F.concat(*[_candidates(k, kind) for k, kind in enumerate(KINDS)])
    rows = texts.withColumn("base", base).withColumn("found", found).drop("text")
    return rows.withColumn("found", _free(F.col("base"), F.col("found")))


def _numbers(values: list[float]) -> Column:
    return F.expr(f"array({', '.join(f'{value!r}D' for value in values)})")


def _believed(evidence: list[list[tuple[float, float]]]) -> Column:
    """Probability that a candidate with ``kind`` and ``votes`` is personal data; even odds if nobody votes."""
    odds = F.lit(0.0)
    for j in range(LABELERS):
        yes, no = (F.get(_numbers([of_kind[j][side] for of_kind in evidence]), F.col("kind")) for side in (0, 1))
        vote = F.get("votes", F.lit(j))
        odds = odds + F.when(vote == 1, yes).when(vote == -1, no).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def reliabilities(patterns: DataFrame) -> list[list[tuple[float, float]]]:
    """Per kind and labeler what a vote for and a vote against are worth, in log odds.

    ``patterns`` has kind, votes and n, at most 81 rows a kind. A round is one aggregation of it: how often
    each labeler says what of either class, given the probabilities that follow from the round before.
    """

    def weigh(counts: dict[str, float]) -> list[tuple[float, float]]:
        out = []
        for j in range(LABELERS):
            said = {(y, v): ASSUMED[y][v] + counts.get(f"n{y}{j}{v + 1}", 0.0) for y in (0, 1) for v in (-1, 1)}
            share = {(y, v): n / (said[y, -1] + said[y, 1]) for (y, v), n in said.items()}
            out.append((log(share[1, 1] / share[0, 1]), log(share[1, -1] / share[0, -1])))
        return out

    sums = [f"sum(if(votes[{j}] = {v}, {y} * n, 0D)) AS n{i}{j}{v + 1}" for i, y in enumerate(("(1 - one)", "one")) for j in range(LABELERS) for v in (-1, 1)]
    evidence = [weigh({}) for _ in KINDS]
    for _ in range(ROUNDS):
        rows = patterns.withColumn("one", _believed(evidence)).groupBy("kind").agg(*map(F.expr, sums)).collect()  # one row a kind
        counts = {row["kind"]: row.asDict() for row in rows}
        new = [weigh(counts.get(k, {})) for k in range(len(KINDS))]
        moved = max(abs(a - b) for x, y in zip(new, evidence, strict=True) for v, w in zip(x, y, strict=True) for a, b in zip(v, w, strict=True))
        evidence = new
        if moved < CLOSE:
            break
    return evidence


def train(candidates: DataFrame, evidence: list[list[tuple[float, float]]]) -> list[float]:
    """Weights of all features of all kinds: naive Bayes on the labelers' probabilities, from even odds."""
    # Whole millionths, so that sums don't depend on their order.
    one = F.round(_believed(evidence) * 1_000_000).cast("long")
    labelled = candidates.select("kind", one.alias("one"), F.explode("features").alias("bin"))
    sums = labelled.groupBy("kind", "bin").agg(F.sum("one").alias("one"), F.count(F.lit(1)).alias("n")).collect()  # at most BINS rows a kind
    ones, rows = [0.0] * len(KINDS), [0.0] * len(KINDS)
    for row in sums:
        ones[row["kind"]] += row["one"] / 1e6 / FEATURES
        rows[row["kind"]] += row["n"] / FEATURES
    weights = [log((rows[k] - ones[k] + 2) / (ones[k] + 2)) for k in range(len(KINDS)) for _ in range(BINS)]
    for row in sums:
        yes = row["one"] / 1e6
        weights[row["kind"] * BINS + row["bin"]] += log((yes + 1) / (row["n"] - yes + 1))
    return weights


def _added(weights: list[float]) -> Column:
    """The free candidates that the classifier takes, as (start, kind, end)."""
    odds = lambda x: F.aggregate(
        x["features"], F.lit(0.0), lambda total, feature: total + F.get(_numbers(weights), x["kind"] * BINS + feature)
    )
    taken = F.filter("found", lambda x: x["free"] & (odds(x) >= log(SURE / (1 - SURE))))
    return F.array_sort(F.transform(taken, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    shown = F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(shown, ",")


def _count(k: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows without their texts as ``row``, with n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added. The counts and the hash are of base spans."""
    others = F.struct(*[F.col(c) for c in docs.columns if c != text_col])
    rows = stored(spans_of(docs.select(others.alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))), "spans")
    candidates = rows.select(F.explode("found").alias("x")).select("x.kind", "x.votes", "x.features")
    patterns = candidates.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "votes").coalesce(1)
    weights = train(candidates, reliabilities(stored(patterns, "patterns")))

    rows = rows.withColumn("_added", _added(weights))
    apart = lambda taken, ends: F.filter(taken, lambda x, i: F.coalesce(F.get(ends, i - 1), F.lit(0)) <= x["start"])
    ends = lambda taken: running(F.transform(taken, lambda x: x["end"]), lambda a, b: F.greatest(a, b), 0)
    rows = rows.withColumn("_added", let(F.col("_added"), lambda taken: let(ends(taken), lambda found: apart(taken, found))))
    return rows.select(
        "row",
        *[_count(k).alias(f"n_{kind.name}") for k, kind in enumerate(KINDS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "_added"))).alias("spans"),
        F.size("_added").cast("long").alias("n_added"),
    )

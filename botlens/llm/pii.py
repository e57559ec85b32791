"""Personal data by candidate gradient boosting, on built-in functions only.

**Base spans** are matches of four fixed patterns that pass a check: e-mail, IP address, card number
(13 to 19 digits, Luhn), phone number (+, 9 to 15 digits).

**Candidates** come from looser generators whose spans overlap the base ones and one another: e-mail
addresses with written-out or spaced signs, and digit groups with any usual separators. Boosted
trees judge a candidate by its format (checksum, octets, groups, separators) and by the words around it.

Labels do not repeat the base patterns. Every base span of all documents is rewritten in the
forms that the base patterns miss (``name [at] host [dot] tld``, a card with dots or slashes, a phone
without plus), with the text around it, half of them after a word that announces such data: these are examples. Look-alikes
at the same places are not: versions, dates, order numbers, groups over 255, card numbers whose checksum
fails, "word at word dot word", and phone-like numbers after words such as *order* or *version*. Candidates
that overlap no base span could be either and are no examples. Trees are fitted on half of the documents; on the
others, each kind's threshold is the lowest score from which ``precision`` of the examples and look-alikes
are examples (``Judge.measured`` has precision and recall there, of made forms). Candidates of any document
at or above it that overlap no base span are added. The trees become one column expression, so scoring stays in generated SQL.

No document is left out of the fit: base spans of all are kept with a few characters around them, not whole texts. An
address of four valid octets is always a base span, so that kind has no additions.

Defined results: null text is empty and has no spans. Repeated rows give repeated results (and fall
into the same half). Without two kinds of examples nothing is added. An empty table gives an empty
table; other columns are not looked at. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botlens.llm import spans
from botlens.llm.common import discard, saved

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. They begin where a run of their first class begins, or right after
#: the last match, and keep what they have read, so no text takes more than linear time; what they
#: find is what the plain patterns find.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_GUARDS = {"email": "@", "ip": ".", "phone": "+"}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Candidate generators.
_LOOSE = {
    "address": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:(?: ?@ ?| ?[\[({] ?(?:at|AT) ?[\])}] ?)[A-Za-z0-9-]++"
        r"(?:(?:\.| ?[\[({] ?(?:dot|DOT) ?[\])}] ?| (?:dot|DOT) )[A-Za-z0-9-]++)++"
        r"| (?:at|AT) [A-Za-z0-9-]++(?: (?:dot|DOT) [A-Za-z0-9-]++)++)"
    ),
    "digits": r"(?<![0-9])[+(]?[0-9][0-9(). /-]{6,40}[0-9](?![0-9])",
}
_LOOSE_GUARDS = {"address": r"@|[\[({] ?(?:at|AT) ?[\])}]| (?:dot|DOT) ", "digits": r"[0-9][0-9(). /-]{6}"}
_HINTS = {
    "hint_phone": r"(?i)tel|phone|call|fax|mobil|whatsapp|sms",
    "hint_card": r"(?i)card|visa|credit|pay|karte|carte|tarjeta",
    "hint_mail": r"(?i)mail|contact|write|correo",
    "hint_host": r"(?i)\bip\b|host|server|address|login|from",
    "hint_other": r"(?i)version|isbn|order|date|price|page|\bid\b|no\.|art\.",
}
_CANDIDATE = "array<struct<kind: int, start: int, stop: int, x: array<double>>>"
FEATURES = (
    "kind", "length", "digits", "groups", "longest_group", "dots", "spaces", "dashes", "slashes", "parens", "plus",
    "letters", "luhn", "octets", "touches_before", "touches_after", *_HINTS,
)


def _passes(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def _pieces(text: Column) -> dict[str, Column]:
    """Gaps and matches of all patterns: one text scan each, for texts that have a chance."""
    out = {}
    for kind, pattern in PATTERNS.items():
        guard = text.contains(_GUARDS[kind]) if kind in _GUARDS else text.rlike("[0-9](?:[ -]?[0-9]){12}")
        out[f"{kind}_gaps"], out[f"{kind}_found"] = spans.gaps(text, pattern, guard)
    for name, pattern in _LOOSE.items():
        out[f"{name}_gaps"], out[f"{name}_found"] = spans.gaps(text, pattern, text.rlike(_LOOSE_GUARDS[name]))
    return out


def _base(kind: str) -> Column:
    """Spans of a kind: start, stop."""
    between, found = F.col(f"{kind}_gaps"), F.col(f"{kind}_found")
    at = F.arrays_zip(spans.starts(between, found).alias("start"), found.alias("m"))
    good = F.filter(at, lambda z: _passes(kind, z["m"]))
    number = F.lit(KINDS.index(kind))
    return F.transform(
        good, lambda z: F.struct(number.alias("kind"), z["start"].alias("start"), (z["start"] + F.length(z["m"])).alias("stop"))
    )


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _features(match: Column, before: Column, after: Column) -> tuple[Column, list[Column]]:
    digits = F.regexp_replace(match, "[^0-9]", "")
    groups = F.filter(F.split(match, "[^0-9]+"), lambda g: g != "")
    octets = match.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    kind = (
        F.when(match.rlike("[A-Za-z]"), 0).when(octets, 1)
        .when(F.length(digits) >= 13, 2).otherwise(3)
    )
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    columns = [
        kind, F.length(match), F.length(digits), F.size(groups), F.array_max(F.transform(groups, F.length)),
        _count(match, r"\."), _count(match, " "), _count(match, "-"), _count(match, "/"), _count(match, r"[()\[\]{}]"),
        match.startswith("+"), _count(match, "[A-Za-z]"), F.length(digits).between(13, 19) & F.call_function("luhn_check", digits),
        octets, before.rlike(r"[\p{L}\p{N}]$"), after.rlike(r"^[\p{L}\p{N}]"),
        *(before.rlike(pattern) for pattern in _HINTS.values()),
    ]
    return kind, [number(c) for c in columns]


def _loose(name: str) -> Column:
    """Candidates of a generator: kind, start, stop, features."""
    between, found = F.col(f"{name}_gaps"), F.col(f"{name}_found")
    count = F.size(found)
    at = F.arrays_zip(
        spans.starts(between, found).alias("start"), found.alias("m"),
        F.transform(F.slice(between, 1, count), lambda g: F.substring(g, -32, 32)).alias("before"),
        F.transform(F.slice(between, 2, count), lambda g: F.substring(g, 1, 8)).alias("after"),
    )

    def candidate(z: Column) -> Column:
        kind, columns = _features(z["m"], z["before"], z["after"])
        return F.struct(kind.alias("kind"), z["start"].alias("start"), (z["start"] + F.length(z["m"])).alias("stop"), F.array(*columns).alias("x"))

    return F.transform(at, candidate)


def _found(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id, base spans by kind, and candidates, of every document; also ``_text`` without nulls."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    pieces = docs.select(F.col(id_column), text.alias("_text")).select(id_column, "_text", *(c.alias(n) for n, c in _pieces(F.col("_text")).items()))
    base = [_base(kind).alias(f"_{kind}") for kind in KINDS]
    candidates = F.concat(*(_loose(name) for name in _LOOSE)).cast(_CANDIDATE)
    return pieces.select(id_column, "_text", *base, candidates.alias("_candidates"))


def _overlaps(base: Column, span: Column) -> Column:
    return F.exists(base, lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))


@dataclass(frozen=True)
class Judge:
    """Trees as nested tuples (feature, threshold, below, above), leaves as numbers; thresholds of the
    summed trees by kind, None where nothing is added; precision and recall by kind on the examples
    that the fit did not see."""

    trees: tuple
    weights: tuple[float, ...]
    thresholds: tuple[float | None, ...]
    measured: tuple[tuple[float, float] | None, ...] = ()

    def score(self, x: Column) -> Column:
        def value(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, threshold, below, above = node
            return F.when(F.get(x, F.lit(feature)) <= threshold, value(below)).otherwise(value(above))

        return sum((value(t) * F.lit(w) for t, w in zip(self.trees, self.weights)), F.lit(0.0))

    def accepts(self, candidate: Column) -> Column:
        limit = F.lit(None).cast("double")
        for number, threshold in enumerate(self.thresholds):
            if threshold is not None:
                limit = F.when(candidate["kind"] == number, F.lit(threshold)).otherwise(limit)
        return F.coalesce(self.score(candidate["x"]) >= limit, F.lit(False))


def _tree(node):
    """A fitted tree's node as nested tuples."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


#: Words that announce a kind, and words that announce other numbers.
_LEADS = {"email": ("mail ", "contact ", "write to "), "card": ("card ", "credit card: ", "pay with "), "phone": ("call ", "tel. ", "phone: ")}
_OTHER_LEADS = ("version ", "order ", "isbn ", "date ", "page ", "no. ")


def _rewritten(kind: str, match: Column, number: Column) -> list[tuple[float, bool, Column]]:
    """Forms of a base span as (label, after an announcing word in any case, text); ``number`` has 18 digits."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    d = lambda at, size: F.substring(number, at, size)
    grouped = lambda of, by: F.regexp_replace(of, "(.{4})(?!$)", f"$1{by}")
    if kind == "email":
        word = F.regexp_extract(match, "[A-Za-z]+", 0)
        forms = [
            (0.0, False, F.concat(word, F.lit(" at the dot "), word)), (0.0, False, F.concat(word, F.lit(" at noon dot "), word)),
            (0.0, False, F.concat(word, F.lit(" at "), d(1, 1), F.lit(" dot "), d(2, 2))),
        ]
        # Names with figures and dots, and names of letters only.
        for address in (match, F.regexp_replace(match, r"[0-9]|[.](?=.*@)", "")):
            dotted = lambda by, address=address: F.regexp_replace(address, r"\.(?=[A-Za-z0-9.-]*$)", by)
            forms += [
                (1.0, False, address), (1.0, False, F.regexp_replace(dotted(" [dot] "), "@", " [at] ")),
                (1.0, False, F.regexp_replace(dotted("(dot)"), "@", "(at)")), (1.0, False, F.regexp_replace(address, "@", " (at) ")),
                (1.0, False, F.regexp_replace(dotted(" dot "), "@", " (at) ")), (1.0, False, F.regexp_replace(address, "@", " @ ")),
                (1.0, True, F.regexp_replace(dotted(" dot "), "@", " at ")),
                # The same words without an announcing one: only the context tells.
                (0.0, False, F.regexp_replace(dotted(" dot "), "@", " at ")),
            ]
        return forms
    year = F.concat(F.lit("20"), d(1, 2))
    month, day = (F.lpad((d(at, 4).cast("int") % n + 1).cast("string"), 2, "0") for at, n in ((3, 12), (7, 28)))
    unlike = [
        (0.0, False, F.concat_ws(".", d(1, 1), d(2, 2), d(4, 3), d(7, 4))), (0.0, False, F.concat_ws("-", year, month, day)),
        (0.0, False, F.concat(year, F.lit("-"), month, F.lit(" - "), year, F.lit("-"), day)), (0.0, False, F.concat_ws("/", day, month, year)),
        (0.0, False, F.concat_ws("-", d(1, 3), d(4, 7), d(11, 7))), (0.0, False, F.concat_ws(" ", d(1, 2), d(3, 3), d(6, 3))),
        (0.0, False, F.concat_ws(".", *(F.concat(F.lit("9"), d(i, 2)) for i in (1, 3, 5, 7)))),
    ]
    if kind == "card":
        spare = F.expr("substring(digits, 1, length(digits) - 1)")
        wrong = F.concat(spare, ((F.substring(digits, -1, 1).cast("int") + 1) % 10).cast("string"))
        forms = [(label, False, grouped(of, by)) for label, of in ((1.0, digits), (0.0, wrong)) for by in (".", "/", " / ", " - ", " ")]
        return [*forms, (1.0, False, digits), (0.0, False, wrong), *unlike]
    if kind == "phone":
        last = F.substring(digits, -10, 10)
        parted = lambda by: F.regexp_replace(last, "^(.{3})(.{3})", by)
        forms = [parted(by) for by in ("$1-$2-", "($1) $2-", "$1.$2.", "$1 $2 ", "$1/$2-")]
        return [(1.0, False, match), *((1.0, False, f) for f in forms), *((-1.0, False, f) for f in forms), *unlike]
    return unlike


def _places(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """kind, match, before, after, doc and seed of every base span of every document."""
    found = _found(docs, id_column, text_column)
    at = found.select(F.xxhash64(id_column).alias("doc"), "_text", F.explode(F.concat(*(f"_{k}" for k in KINDS))).alias("s"))
    return at.select(
        F.col("s.kind").alias("kind"), "doc", F.expr("substring(_text, s.start + 1, s.stop - s.start)").alias("match"),
        F.expr("substring(_text, s.stop + 1, 8)").alias("after"),
        F.expr("substring(_text, greatest(s.start - 31, 1), least(s.start, 32))").alias("before"), F.xxhash64("doc", "s.start").alias("seed"),
    )


def _examples(places: DataFrame) -> DataFrame:
    """kind, x, label and fit of made forms of each base span, at its place; rows of :func:`_places`.

    A label of -1 in :func:`_rewritten` is a look-alike that only the announcing word tells from an example.
    """
    parts = []
    for kind in KINDS:
        at = places.where(F.col("kind") == KINDS.index(kind))
        number = F.lpad(F.pmod("seed", F.lit(10**18)).cast("string"), 18, "7")
        at = at.withColumn("digits", F.regexp_replace("match", "[^0-9]", ""))
        made = [
            F.struct(F.lit(label).alias("label"), F.lit(always).alias("led"), text.alias("form"), F.lit(i).alias("i"))
            for i, (label, always, text) in enumerate(_rewritten(kind, F.col("match"), number))
        ]
        forms = at.select("doc", "seed", "before", "after", F.explode(F.array(*made)).alias("made"))
        draw = F.pmod(F.xxhash64("seed", "made.i"), F.lit(1 << 20))
        pick = lambda words: F.get(F.array(*(F.lit(w) for w in words)), (draw / 2).cast("int") % len(words))
        own, other = pick(_LEADS.get(kind, _OTHER_LEADS)), pick(_OTHER_LEADS)
        half = draw % 2 == 0
        lead = (
            F.when((F.col("made.label") < 0) | ((F.col("made.label") == 0) & half & F.lit(kind != "email")), other)
            .when(F.col("made.led") | ((F.col("made.label") > 0) & half), own).otherwise("")
        )
        before = F.when(lead == "", F.col("before")).otherwise(F.concat(F.regexp_replace("before", r"\S*$", ""), lead))
        number_of, columns = _features(F.col("made.form"), before, F.col("after"))
        parts.append(forms.select(
            number_of.cast("int").alias("kind"), F.array(*columns).alias("x"), F.greatest("made.label", F.lit(0.0)).alias("label"),
            (F.pmod("doc", F.lit(2)) == 0).alias("fit"),
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def fitted(docs: DataFrame, precision: float = 0.95, trees: int = 12, depth: int = 4,
           id_column: str = "doc_id", text_column: str = "text") -> Judge:
    """Trees and thresholds from the base spans of all documents."""
    nothing = Judge((), (), (None,) * len(KINDS))
    places = saved(_places(docs, id_column, text_column))
    examples = _examples(places)
    columns = [F.get("x", F.lit(i)).alias(f"f_{name}") for i, name in enumerate(FEATURES)]
    data = saved(examples.select("kind", "label", "fit", *columns))
    discard(places)
    vectors = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(data)
    kinds_there = data.where("fit").select("label").distinct().count()
    if kinds_there < 2:
        discard(data)
        return nothing
    model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=5, cacheNodeIds=False).fit(vectors.where("fit"))
    forest = tuple(_tree(t._java_obj.rootNode()) for t in model.trees)
    judge = Judge(forest, tuple(float(w) for w in model.treeWeights), nothing.thresholds)
    # Calibration: per kind, shares of examples from each score on; scores of trees are few.
    by_score = (
        data.where("not fit").groupBy("kind", judge.score(F.array(*(f"f_{n}" for n in FEATURES))).alias("score"))
        .agg(F.sum("label").alias("good"), F.count("*").alias("all")).collect()
    )
    limits: list[float | None] = []
    measured: list[tuple[float, float] | None] = []
    for number in range(len(KINDS)):
        good = every = 0
        limit = reached = None
        of_kind = sorted((r for r in by_score if r["kind"] == number), key=lambda r: -r["score"])
        there = sum(r["good"] for r in of_kind)
        for row in of_kind:
            good, every = good + row["good"], every + row["all"]
            if row["score"] > 0 and good >= precision * every:
                limit, reached = row["score"] - 1e-9, (good / every, good / there)
        limits.append(limit)
        measured.append(reached)
    discard(data)
    return Judge(forest, judge.weights, tuple(limits), tuple(measured))


def _joined(items: Column) -> Column:
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(items, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["stop"])), ",")


def personal_data(docs: DataFrame, judge: Judge | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    judge = judge or fitted(docs, id_column=id_column, text_column=text_column)
    rows = _found(docs, id_column, text_column).withColumn("_base", F.concat(*(f"_{k}" for k in KINDS)))
    plain = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop"))
    accepted = F.filter("_candidates", judge.accepts)
    added = F.array_distinct(F.transform(F.filter(accepted, lambda c: ~_overlaps(F.col("_base"), c)), plain))
    rows = rows.withColumn("_added", added)
    return rows.select(
        id_column, *(F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS),
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("_base", "_added"))).alias("spans"),
        F.size("_added").cast("bigint").alias("n_added"),
    )


def redacted(docs: DataFrame, judge: Judge | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and text with every span replaced by its kind in brackets; overlapping added spans merge
    into the first. Null text stays null."""
    judge = judge or fitted(docs, id_column=id_column, text_column=text_column)
    text = F.coalesce(F.col(text_column), F.lit(""))
    pieces = docs.select(id_column, text_column, *(c.alias(n) for n, c in _pieces(text).items()))
    base = F.concat(*(_base(kind) for kind in KINDS))
    candidates = F.concat(*(_loose(name) for name in _LOOSE)).cast(_CANDIDATE)
    rows = pieces.select(id_column, text_column, base.alias("_base"), candidates.alias("_candidates"))
    accepted = F.filter("_candidates", judge.accepts)
    place = lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind"))
    every = F.array_sort(F.concat(F.transform("_base", place), F.transform(F.filter(accepted, lambda c: ~_overlaps(F.col("_base"), c)), place)))
    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    name = F.array(*(F.lit(k) for k in KINDS))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(F.col(text_column), done["at"] + 1, s["start"] - done["at"])
        more = F.concat(done["out"], gap, F.lit("["), F.get(name, s["kind"]), F.lit("]"))
        covered = s["start"] < done["at"]
        return F.struct(
            F.when(covered, done["out"]).otherwise(more).alias("out"), F.greatest(done["at"], s["stop"]).alias("at")
        )

    done = F.aggregate("_spans", empty, step)
    rows = rows.select(id_column, text_column, every.alias("_spans")).withColumn("_done", done)
    rest = F.substring(F.col(text_column), F.col("_done.at") + 1, F.length(text_column))
    return rows.select(id_column, F.concat("_done.out", rest).alias(text_column))

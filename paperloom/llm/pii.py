"""Personal data: spans by fixed rules, and more spans chosen by boosted trees.

Generators with high recall propose spans of four kinds, which may overlap. Matches of the base patterns
that pass a kind's fixed rule (the *base* spans) always stay, and those that fail it go. Proposals of the
further patterns are scored by gradient-boosted trees on how the span is written and what stands around it,
and are added above a threshold for each kind.

The trees are fitted by Spark on the proposals of all different texts, each counted once. A further proposal is
right if it lies over a base span of its own kind, wrong if over one of another kind, and otherwise by a rule
of its own (``further_rule``): brackets or spelled words and a known ending for addresses, valid groups
with a digit for IPv6, check digit and leading digit for cards, one separator or a bracketed prefix for
numbers. The threshold of a kind is calibrated on further proposals of a held-out part alone: the lowest
score from which on the share of right ones reaches ``PRECISION``, with ``LEAST_RIGHT`` of them at least; a
kind without that evidence adds nothing. Added spans never overlap base spans, and of two that overlap the
better one stays. The spans of one kind never overlap each other, so overlaps are found by binary search.

Everything runs as built-in expressions in one pass over the documents, the trees included: they are
written out as nested conditions. Positions follow from the text cut at its matches. Patterns are
possessive and start at the start of a run, so that their time grows with the text only.

Defined results: a null text is empty; very long texts are read whole; repeated rows get the same
spans; an empty table gives no rows and adds no spans. Columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import sampled_texts, whole

KINDS = ("email", "ip", "card", "phone")
MARK, OTHER = "\ue000", "\ue001"  # private characters; the first is replaced in texts by the second
CONTEXT = 40
PRECISION = 0.98
LEAST_RIGHT = 20
TREES, DEPTH = 8, 3

# The rules' patterns. Possessive, and bound to the start of a run or the end of the
# match before, which gives the same leftmost matches without trying every start.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a base span to be possible. ``d`` says that it holds a digit.
HOLDS = {
    "email": lambda t, d: t.contains("@") & t.rlike(r"@[A-Za-z0-9-]"),
    "ip": lambda t, d: d & t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda t, d: d & t.rlike(r"(?:[0-9][\x20-]?){11}[0-9]"),
    "phone": lambda t, d: d & t.contains("+"),
}
# Further ways to write the kinds.
MORE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]{2,64}+(?:\x20?[\[(]\x20?at\x20?[\])]\x20?|\x20at\x20)"
             r"[A-Za-z0-9-]{2,64}+(?:(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{2,64}+)++",
    "ip": r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}+(?::[0-9A-Fa-f]{0,4}+){2,7}+(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[.\x20-][0-9]{4}){2}[.\x20-][0-9]{3,7}(?![0-9])",
    "phone": r"(?<![0-9])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20./-][0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9])",
}
MORE_HOLDS = {
    "email": lambda t, d: (t.contains(" at ") | t.contains("at]") | t.contains("at)") | t.contains("at )") | t.contains("at ]"))
    & t.rlike(r"[\x20(\[]at[\x20)\]]{1,3}[A-Za-z0-9-]++[\x20(\[]{0,2}(?:\.|dot)[\x20)\]]{0,2}[A-Za-z0-9-]"),
    "ip": lambda t, d: t.contains(":") & t.rlike(r":[0-9A-Fa-f]{0,4}+:"),
    "card": lambda t, d: d & t.rlike(r"[0-9]{4}[.\x20-][0-9]{4}"),
    "phone": lambda t, d: d & t.rlike(r"[0-9]\)?[\x20./-][0-9]{3}"),
}
WORDS = {
    "email": r"mail|contact|write|@",
    "ip": r"\bip\b|server|host|login|address|network",
    "card": r"card|visa|credit|pay|account|konto|tarjeta|carte",
    "phone": r"phone|call|tel|fax|mobile|number|anruf|llam|appel",
}
# Endings of host names that count as known.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "biz", "io", "eu", "de", "fr", "es", "uk", "it", "nl", "pt", "ch", "ca", "us", "au", "mx", "br")
FEATURES = ("kind", "length", "digits", "letters", "separators", "groups", "longest", "brackets", "colons", "spelled", "known_end",
            "check_digit", "free_before", "free_after", "digits_before", *(f"near_{k}" for k in KINDS))
DEEPEST = 22  # binary search over at most four million spans of one kind in a text


def running(lengths: Column, block: int = 256) -> Column:
    """The sum of all earlier elements, for each element. Blocks keep long arrays cheap."""

    def inside(values: Column, first: Column) -> Column:
        start = F.struct(first.alias("sum"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(values, start, lambda s, x: F.struct(
            (s["sum"] + x).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out")))["out"]

    zero = F.lit(0).cast("long")
    last = F.floor((F.size(lengths) - 1) / block).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(lengths, i * block + 1, block))
    sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, x: s + x))
    # Blocks of blocks, so that a million matches cost no more than some thousand steps each.
    offsets = inside(sums, zero)
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), offsets.alias("o")), lambda z: inside(z["b"], z["o"])))


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def passes(kind: str, hit: Column) -> Column:
    """The fixed rule of a kind, for a match of its base pattern."""
    digits = digits_of(hit)
    if kind == "ip":
        def small(part: Column) -> Column:
            short = F.regexp_replace(part, "^0+(?=.)", "")
            return (F.length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)

        return F.forall(F.split(hit, r"\."), small)
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def proposals(docs: DataFrame, text: Column) -> DataFrame:
    """``row``, ``base`` and ``more``: arrays of ``start, stop, kind, hit, before, after, ok``.

    ``ok`` says that the kind's rule holds; ``base`` has the matches of the base patterns and
    ``more`` those of the other ones.
    """
    clean = F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(OTHER))
    out = docs.select(whole(docs).alias("row"), clean.alias("text")).withColumn("digit", F.col("text").rlike("[0-9]"))
    sides = {"base": (BASE, HOLDS), "more": (MORE, MORE_HOLDS)}
    none = F.lit(None).cast("array<string>")
    out = out.withColumns({
        f"{side}_{k}": F.when(holds[k](F.col("text"), F.col("digit")),
                              F.split(F.regexp_replace("text", patterns[k], f"{MARK}$0{MARK}"), MARK)).otherwise(none)
        for side, (patterns, holds) in sides.items() for k in KINDS})
    # A text without a match is one piece; nothing more is done with it.
    out = out.withColumns({f"{side}_{k}": F.when(F.size(f"{side}_{k}") > 1, F.col(f"{side}_{k}"))
                           for side in sides for k in KINDS}).drop("text", "digit")
    out = out.withColumns({f"{side}_{k}_at": F.when(
        F.col(f"{side}_{k}").isNotNull(), running(F.transform(f"{side}_{k}", lambda s: F.length(s).cast("long"))))
        for side in sides for k in KINDS})

    def spans(side: str, number: int, kind: str) -> Column:
        pieces, at = F.col(f"{side}_{kind}"), F.col(f"{side}_{kind}_at")

        def one(i: Column) -> Column:
            start, hit = F.get(at, i), F.get(pieces, i)
            before = F.get(pieces, i - 1)
            after = F.get(pieces, i + 1)
            return F.struct(
                start.alias("start"), (start + F.length(hit)).alias("stop"), F.lit(number).alias("kind"), hit.alias("hit"),
                F.lower(F.right(before, F.lit(CONTEXT))).alias("before"), F.substring(after, 1, 1).alias("after"),
                (passes(kind, hit) if side == "base" else F.lit(False)).alias("ok"))

        # The matches are every second piece.
        found = F.transform(F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)), one)
        return F.when(pieces.isNotNull(), found).otherwise(F.array().cast(SPAN))

    return out.select("row", *[
        F.sort_array(F.concat(*[spans(side, n, k) for n, k in enumerate(KINDS)])).alias(side) for side in sides])


SPAN = ("array<struct<start:long,stop:long,kind:int,hit:string,before:string,after:string,ok:boolean>>")


def known_end(hit: Column) -> Column:
    return F.lower(F.regexp_extract(hit, "([A-Za-z]+)[^A-Za-z]*$", 1)).isin(*ENDINGS)


def further_rule(s: Column) -> Column:
    """Whether a match of a further pattern is taken for right when no base span says so."""
    hit, digits = s["hit"], digits_of(s["hit"])
    spelled_at = hit.rlike(r"[\[(]\x20?at\x20?[\])]")
    email = known_end(hit) & (spelled_at | hit.rlike(r"\x20at\x20.*\x20dot\x20"))
    groups = F.filter(F.split(hit, ":"), lambda g: g != "")
    gap = F.size(F.split(hit, "::", -1)) - 1
    ip = digits.rlike("[0-9]") & ~hit.rlike("^:[^:]|[^:]:$|:::") & (
        ((gap == 0) & (F.size(groups) == 8)) | ((gap == 1) & F.size(groups).between(3, 7)))
    card = F.length(digits).between(13, 19) & digits.rlike("^[3-6]") & F.call_function("luhn_check", F.substring(digits, 1, 19))
    marks = F.regexp_replace(hit, "[0-9]", "")
    phone = F.length(digits).between(9, 11) & (hit.startswith("(") | (F.substring(marks, 1, 1) == F.substring(marks, 2, 1)))
    return F.when(s["kind"] == 0, email).when(s["kind"] == 1, ip).when(s["kind"] == 2, card).otherwise(phone)


def feature_columns(s: Column) -> dict[str, Column]:
    hit, before = s["hit"], s["before"]
    digits = F.length(digits_of(hit))
    letters = F.length(F.regexp_replace(hit, "[^A-Za-z]", ""))
    groups = F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")
    out = {
        "kind": s["kind"], "length": F.length(hit), "digits": digits, "letters": letters,
        "separators": F.length(hit) - digits - letters, "groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "brackets": F.length(F.regexp_replace(hit, r"[^()\[\]]", "")), "colons": F.length(F.regexp_replace(hit, "[^:]", "")),
        "spelled": F.size(F.split(F.lower(hit), r"[^a-z](?:at|dot)[^a-z]")), "known_end": known_end(hit),
        "check_digit": (digits >= 12) & F.call_function("luhn_check", F.substring(digits_of(hit), 1, 19)),
        "free_before": before.rlike(r"(?:^|[\s(])$"), "free_after": s["after"].rlike(r"^(?:$|[\s.,;)])"),
        "digits_before": F.length(F.regexp_replace(before, "[^0-9]", "")),
    } | {f"near_{k}": before.rlike(words) for k, words in WORDS.items()}
    return {name: out[name].cast("double") for name in FEATURES}


def _count(spans: Column, goes: Callable[[Column], Column]) -> Column:
    """How many spans, in order and without overlap, come before a place: ``goes`` says it of one span."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(DEEPEST))])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.coalesce(goes(F.get(spans, at + step - 1)), F.lit(False)), step).otherwise(0))


def meeting(s: Column, spans: Column) -> Column:
    """Those of ``spans`` (of one kind, so in order and without overlap) that share a place with ``s``."""
    ended = _count(spans, lambda b: b["stop"] <= s["start"])
    begun = _count(spans, lambda b: b["start"] < s["stop"])
    return F.slice(spans, ended + 1, F.greatest(begun - ended, F.lit(0)))


def over(s: Column, kinds: list[Column]) -> Column:
    """Whether a span shares a place with a span of any of the lists."""
    return reduce(lambda a, b: a | b, [(F.size(spans) > 0) & (F.size(meeting(s, spans)) > 0) for spans in kinds], F.lit(False))


def by_kind(spans: str | Column) -> list[Column]:
    def of(number: int) -> Column:
        return F.filter(spans, lambda s: s["kind"] == number)

    return [of(n) for n in range(len(KINDS))]


@dataclass
class Model:
    """Trees as (feature, limit, left, right) or a number, with their weights, and the thresholds."""

    trees: list = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, values: Column) -> Column:
        """The calibrated order of proposals: the trees' probability, from a struct of features."""
        def walk(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            name, limit, left, right = tree
            return F.when(values[name] <= limit, walk(left)).otherwise(walk(right))

        margin = reduce(lambda a, b: a + b, [walk(t) * w for t, w in zip(self.trees, self.weights)], F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))


def _tree(node) -> tuple | float:
    """A fitted tree's nodes, read once on the driver."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (FEATURES[split.featureIndex()], float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def train(docs: DataFrame, *, text_col: str = "text", sample: int | None = None) -> Model:
    """Fit trees and thresholds on all different texts that hold a proposal, or about ``sample`` of them."""
    text = F.col(f"`{text_col}`").cast("string")
    digit = text.rlike("[0-9]")
    any_hit = reduce(lambda a, b: a | b, [h(text, digit) for h in (*HOLDS.values(), *MORE_HOLDS.values())])
    rows = docs.where(any_hit).select(text.alias("text"))
    rows = rows.distinct() if sample is None else sampled_texts(rows, sample)
    found = proposals(rows, F.col("text")).select("row.text", "base", "more")
    found = found.withColumns({f"right_{n}": c for n, c in enumerate(by_kind(F.filter("base", lambda s: s["ok"])))})
    rights = [F.col(f"right_{n}") for n in range(len(KINDS))]

    def labelled(s: Column, label: Column, further: bool) -> Column:
        return F.struct(*[s[k].alias(k) for k in ("kind", "hit", "before", "after")], label.alias("label"), F.lit(further).alias("further"))

    def own_rule(s: Column) -> Column:
        own = reduce(lambda a, n: a | ((s["kind"] == n) & over(s, [rights[n]])), range(len(KINDS)), F.lit(False))
        return F.when(own, 1.0).when(over(s, rights), 0.0).otherwise(further_rule(s).cast("double"))

    # Labelled inside the row and written before they are listed: a listed span carries neither its text nor
    # its neighbours, and the filter that goes with ``explode`` does not run the patterns again.
    found = materialize(found.select(
        (F.pmod(F.xxhash64("text"), F.lit(3)) == 0).alias("held"),
        F.concat(F.transform("base", lambda s: labelled(s, s["ok"].cast("double"), False)),
                 F.transform("more", lambda s: labelled(s, own_rule(s), True))).alias("spans")), "proposals")
    s = F.col("s")
    rows = materialize(found.select("held", F.explode("spans").alias("s")).select(
        "held", s["label"].alias("label"), s["further"].alias("further"),
        *[c.alias(k) for k, c in feature_columns(s).items()]), "features")
    fitted, held = rows.where(~F.col("held")), rows.where(F.col("held") & F.col("further"))
    if fitted.select("label").distinct().count() < 2:
        return Model()
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(assembler.transform(fitted))
    model = Model([_tree(t._java_obj.rootNode()) for t in trees.trees],
                  [float(w) for w in trees.treeWeights])
    scored = held.withColumn("v", F.struct(*FEATURES)).withColumn("score", F.round(model.score(F.col("v")), 3))
    bins = scored.groupBy("kind", "score").agg(F.sum("label").alias("right"), F.count("*").alias("all")).collect()
    for number, kind in enumerate(KINDS):
        right = total = 0.0
        for r in sorted((r for r in bins if r["kind"] == number), key=lambda r: -r["score"]):
            right, total = right + r["right"], total + r["all"]
            if right >= LEAST_RIGHT and right >= PRECISION * total:
                model.thresholds[kind] = r["score"]
    return model


def find(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``row`` (all columns), ``base`` and ``spans``: sorted arrays of ``start, kind, stop``.

    ``base`` has what the fixed rules find, ``spans`` that and what the trees add. ``kind`` is a
    place in ``KINDS``; positions are code points, the end exclusive.
    """
    found = proposals(docs, F.col(f"`{text_col}`").cast("string"))
    found = found.withColumn("right", F.filter("base", lambda s: s["ok"])).drop("base")
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["stop"]))
    base = plain(F.col("right"))
    if not model.thresholds:
        return found.select("row", F.sort_array(base).alias("base"), F.sort_array(base).alias("spans"))
    rights = [f"right_{n}" for n in range(len(KINDS))]
    some = F.size("more") > 0
    empty = F.array().cast(SPAN)
    found = found.withColumns({r: F.when(some, c).otherwise(empty) for r, c in zip(rights, by_kind("right"))})
    found = found.withColumn("more", F.filter("more", lambda s: ~over(s, [F.col(r) for r in rights]))).drop(*rights)

    def scored(s: Column) -> Column:
        values = F.struct(*[c.alias(k) for k, c in feature_columns(s).items()])
        least = reduce(lambda a, n: F.when(s["kind"] == n, model.thresholds.get(KINDS[n], 2.0)).otherwise(a),
                       range(len(KINDS)), F.lit(2.0))
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"),
                        F.round(model.score(values), 3).alias("score"), least.alias("least"))

    found = found.withColumn("more", F.filter(F.transform("more", scored), lambda s: s["score"] >= s["least"]))
    found = found.withColumns({f"more_{n}": c for n, c in enumerate(by_kind("more"))})
    # Of spans that overlap, the one with the higher score stays, then the earlier, longer one.
    rank = lambda s: F.struct(-s["score"], s["start"], -s["stop"], s["kind"])
    worse = lambda s: reduce(lambda a, n: a | F.exists(
        meeting(s, F.col(f"more_{n}")), lambda o: rank(o) < rank(s)), range(len(KINDS)), F.lit(False))
    added = plain(F.filter("more", lambda s: ~worse(s)))
    return found.select("row", F.sort_array(base).alias("base"), F.sort_array(F.concat(base, added)).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))


def redact(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets."""
    found = find(docs, model, text_col=text_col)
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate("spans", start, lambda a, s: F.struct(
        F.greatest(a["at"], s["stop"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(
            F.substr(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.get(names, s["kind"])))).alias("out")))
    redacted = F.concat(F.concat_ws("", done["out"]), F.substr(text, (done["at"] + 1).cast("int")))
    changed = F.when(F.size("spans") > 0, redacted).otherwise(F.col("row")[text_col].cast("string"))
    return found.select(F.col("row").withField(f"`{text_col}`", changed).alias("row")).select("row.*")

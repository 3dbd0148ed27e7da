"""Operator 3: personal data by candidate generation and gradient boosting.

Everything on the main path is DataFrame functions and Spark ML. Four base
patterns with their checks give the spans that always count. High-recall
generators propose further, overlapping spans: for cards and phones every run
of digit groups of a fitting length, from every group on, so that a number
beside another one is among them; boosted trees rate them by format and context. They learn from the corpus: proposals that the base rules
confirm are positive, and so is each base span written another way (00 for +,
(at) for @, dots for blanks) where it stands; proposals that fail the check of
their kind in any such writing are negative; those that pass it may be personal
data that no base rule confirms and count as neither. A
threshold a kind, calibrated on all rows held back, selects those that are
added. The trees are written out as column expressions, so that rating needs
no row exchange.

Positions come from the pieces between matches: a match starts where the
lengths of all pieces and matches before it end (code points, end exclusive).

Defined cases: null and empty texts have no spans; proposals that overlap a
base span are not added (what they cover is found already); of overlapping
additions the better rated stays, then the kind first in order, then the first
and the longest; without
proposals of both sorts, or without a threshold that is precise enough,
nothing is added; repeated rows are each returned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.text import SAMPLE_STEPS, sample_cut, stored

KINDS = ("email", "ip", "card", "phone")
# proposals that trees are fitted on, at most; thresholds take all others
SAMPLE = 20_000
PRECISION = 0.98
PRIOR_ROWS = 20  # weight of all kinds together in the precision of one of them
TREES, DEPTH = 10, 3

# The base patterns in possessive form: same matches, but time linear in the
# text and no recursion. A local part begins where none goes on before it.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?: ?[\(\[\{](?:at|AT)[\)\]\}] ?|@)[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\(\[\{](?:dot|DOT)[\)\]\}] ?)[A-Za-z0-9-]{1,63}){1,4}",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}|(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4})",
}
# Digit groups of a card or a phone: what may stand between them, the least and the
# most digits they hold together, and what may open them.
RUNS = {"card": (r"^[ ./-]{1,2}$", 13, 19, "^$"), "phone": (r"^[ ()./-]{1,3}$", 9, 15, r"[+(]{1,2}$")}
BEFORE = 24  # characters of context
WORDS = {
    "email": r"(?i)(?:mail|contact)",
    "ip": r"(?i)(?:\bip\b|host|addr|server)",
    "card": r"(?i)(?:card|visa|credit|carte|karte|tarjeta)",
    "phone": r"(?i)(?:phone|tel|call|mobil|fax|\+)",
}
CHUNK = 128

# How a base span is written where the base patterns do not look.
VARIANTS = {"email": ("@", "(at)"), "ip": (r"\.", " . "), "card": ("[ -]", "."), "phone": (r"^\+", "00")}

# How those writings are undone, to ask whether a proposal is a base span but for them.
NORMAL = {
    "email": ((r" ?[\(\[\{](?:at|AT)[\)\]\}] ?", "@"), (r" ?[\(\[\{](?:dot|DOT)[\)\]\}] ?", ".")),
    "ip": ((" ", ""),),
    "card": (("[^0-9]", ""),),
    "phone": (("^00", "+"),),
}

FEATURES = ("kind", "chars", "digits", "letters", "separators", "groups", "longest", "luhn", "checked", "before", "after", "word", "distinct")


def _worth(kind: str, text: Column) -> Column:
    """A cheap test that a text may have a match at all."""
    if kind == "email":
        return text.contains("@") | text.rlike(r"[\(\[\{](?:at|AT)[\)\]\}]")
    if kind == "phone":
        return text.contains("+")
    return text.rlike("[0-9]")


def _placed(text: Column, found: Column, pieces: Column) -> Column:
    """start, end and body of each match, in runs so that long lists stay cheap."""
    pairs = F.arrays_zip(found.alias("m"), F.slice(pieces, F.lit(1), F.size(found)).alias("p"))
    span = "struct<s:int,e:int,m:string>"

    def add(acc: Column, x: Column) -> Column:
        s = acc["n"] + F.length(x["p"])
        e = s + F.length(x["m"])
        one = F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"))
        return F.struct(e.alias("n"), F.concat(acc["out"], F.array(one)).alias("out"))

    empty = F.array().cast(f"array<{span}>")
    runs = F.transform(F.sequence(F.lit(1), F.size(found), F.lit(CHUNK)), lambda i: F.aggregate(F.slice(pairs, i, CHUNK), F.struct(F.lit(0).alias("n"), empty.alias("out")), add))

    def shift(acc: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda y: F.struct((y["s"] + acc["n"]).alias("s"), (y["e"] + acc["n"]).alias("e"), y["m"].alias("m")))
        return F.struct((acc["n"] + x["n"]).alias("n"), F.concat(acc["out"], F.array(moved)).alias("out"))

    lists = F.aggregate(runs, F.struct(F.lit(0).alias("n"), F.array().cast(f"array<array<{span}>>").alias("out")), shift, lambda a: a["out"])
    return F.when(F.size(found) > 0, F.flatten(lists)).otherwise(empty)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + value(i))
    return F.when(n > 0, total % 10 == 0).otherwise(False)


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.cast("double") <= 255)
    digits = _digits(m)
    n = F.length(digits)
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), luhn(digits)).otherwise(False)
    return (n >= 9) & (n <= 15)


def _passes(kind: str, m: Column) -> Column:
    """Whether a proposal is a base span and passes the check once normalised."""
    for pattern, by in NORMAL[kind]:
        m = F.regexp_replace(m, pattern, by)
    return F.coalesce(m.rlike(f"^(?:{BASE[kind]})$") & F.when(m.rlike(f"^(?:{BASE[kind]})$"), _valid(kind, m)), F.lit(False))


def _checked(kind: str):
    return lambda x: _valid(kind, x["m"])


def _span_of(kind: int):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"))


def _is(kind: int):
    return lambda x: x["kind"] == kind


def _class(c: Column) -> Column:
    """0 none or blank, 1 letter, 2 digit, 3 other."""
    return F.when((c == "") | c.rlike(r"^\s$"), 0.0).when(c.rlike("^[A-Za-z]$"), 1.0).when(c.rlike("^[0-9]$"), 2.0).otherwise(3.0)


def _rated_features(kind: str, text: Column, x: Column) -> Column:
    """The features of one proposal: its format and what stands around it."""
    m, s, e = x["m"], x["s"], x["e"]
    digits = _digits(m)
    context = F.substring(text, F.greatest(s - BEFORE, F.lit(0)) + 1, F.least(s, F.lit(BEFORE)))
    groups = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))
    number = lambda c: c.cast("double")
    values = {
        "kind": F.lit(float(KINDS.index(kind))),
        "chars": number(F.length(m)),
        "digits": number(F.length(digits)),
        "letters": number(F.length(F.regexp_replace(m, "[^A-Za-z]", ""))),
        "separators": number(F.length(F.regexp_replace(m, "[A-Za-z0-9]", ""))),
        "groups": number(F.size(groups)),
        "longest": number(F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0))),
        "luhn": number(F.when(F.length(digits).between(8, 24), luhn(digits)).otherwise(False)),
        "checked": number(F.forall(groups, lambda p: p.cast("double") <= 255)),
        "before": _class(F.when(s > 0, F.substring(text, s, F.lit(1))).otherwise("")),
        "after": _class(F.substring(text, e + 1, F.lit(1))),
        "word": number(context.rlike(WORDS[kind])),
        "distinct": number(F.size(F.array_distinct(F.split(digits, "")))),
    }
    return F.struct(s.alias("s"), e.alias("e"), *[values[f].alias(f) for f in FEATURES])


def _grown(kind: str, d: Column) -> Column:
    """s, e, m, hit of every run of digit groups (s, e, m, before, hit: whether a base
    span touches it), from each group on, that fits the kind."""
    between, least, most, opener = RUNS[kind]
    none = F.array().cast("array<struct<s:int,e:int,m:string,hit:boolean>>")
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("m"), F.lit(False).alias("hit"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        # the text so far; null once a group does not belong to it
        m = F.when(acc["n"] == 0, F.concat(F.regexp_extract(x["before"], opener, 0), x["m"])).when(x["before"].rlike(between), F.concat(acc["m"], x["before"], x["m"]))
        now = F.struct((acc["n"] + F.length(x["m"])).alias("n"), m.alias("m"), (acc["hit"] | x["hit"]).alias("hit"))

        def kept(y: Column) -> Column:
            one = F.array(F.struct((x["e"] - F.length(y["m"])).alias("s"), x["e"].alias("e"), y["m"].alias("m"), y["hit"].alias("hit")))
            out = F.when(y["m"].isNotNull() & y["n"].between(least, most), F.concat(acc["out"], one)).otherwise(acc["out"])
            return F.struct(y["n"].alias("n"), y["m"].alias("m"), y["hit"].alias("hit"), out.alias("out"))

        return F.transform(F.array(now), kept)[0]

    # a group has a digit at least, so no fitting run has more than ``most`` of them
    each = F.transform(F.sequence(F.lit(1), F.size(d)), lambda i: F.aggregate(F.slice(d, i, most), start, step, lambda acc: acc["out"]))
    return F.when(F.size(d) > 0, F.flatten(each)).otherwise(none)


def proposals(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """_row (the columns of ``docs``), _base (kind, s, e of the base spans, in order),
    _more (the proposals with their features, whether a base span confirms them
    and whether they pass its check once normalised) and _like (features of the base spans written another way)."""
    keep = [c for c in docs.columns if keep_text or c != text]
    df = docs.select(F.struct(*keep).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    t = F.col("_t")
    none = F.array().cast("array<string>")
    find = lambda p, ok: F.when(ok, F.regexp_extract_all(t, F.lit(p), F.lit(0))).otherwise(none)
    df = df.withColumns({f"_ok_{k}": _worth(k, t) for k in ("email", "phone", "ip")})
    ok = {"email": F.col("_ok_email"), "phone": F.col("_ok_phone"), "ip": F.col("_ok_ip"), "card": F.col("_ok_ip")}
    more = {**GENERATORS, "digits": "[0-9]+"}
    df = df.withColumns({f"_m_{k}": find(BASE[k], ok[k]) for k in KINDS} | {f"_g_{k}": find(p, ok.get(k, ok["ip"])) for k, p in more.items()})
    pieces = lambda c, p: F.when(F.size(c) > 0, F.split(t, p, -1)).otherwise(none)
    df = df.withColumns({f"_p_{k}": pieces(f"_m_{k}", BASE[k]) for k in KINDS} | {f"_q_{k}": pieces(f"_g_{k}", p) for k, p in more.items()})
    df = df.withColumns({f"_s_{k}": _placed(t, F.col(f"_m_{k}"), F.col(f"_p_{k}")) for k in KINDS} | {f"_c_{k}": _placed(t, F.col(f"_g_{k}"), F.col(f"_q_{k}")) for k in more})
    base = []
    for n, k in enumerate(KINDS):
        base.append(F.transform(F.col(f"_v_{k}"), _span_of(n)))
    df = df.withColumns({f"_v_{k}": F.filter(F.col(f"_s_{k}"), _checked(k)) for k in KINDS}).withColumn("_base", F.concat(*base))
    touching = lambda x: F.exists("_base", lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"]))
    # a group of digits is looked up once, however many runs it is in
    group = lambda x, p: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), p.alias("before"), touching(x).alias("hit"))
    df = df.withColumn("_digits", F.zip_with("_c_digits", F.slice("_q_digits", F.lit(1), F.size("_c_digits")), group))
    df = df.withColumns({f"_c_{k}": _grown(k, F.col("_digits")) for k in RUNS})

    def rated(k: str, n: int) -> Column:
        def one(x: Column) -> Column:
            if k in RUNS:  # confirmed is the run that is a base span, not one that only touches it
                same, other = x["hit"] & F.exists("_base", lambda b: (b["kind"] == n) & (b["s"] == x["s"]) & (b["e"] == x["e"])), x["hit"]
            else:
                same, other = F.exists("_base", lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"]) & (b["kind"] == n)), touching(x)
            return F.struct(F.lit(n).alias("n"), same.alias("same"), other.alias("other"), _passes(k, x["m"]).alias("passes"), _rated_features(k, t, x).alias("f"))

        return F.transform(F.col(f"_c_{k}"), one)

    def like(k: str, n: int) -> Column:
        def one(x: Column) -> Column:
            other = F.struct(x["s"].alias("s"), x["e"].alias("e"), F.regexp_replace(x["m"], *VARIANTS[k]).alias("m"))
            return F.struct(F.lit(n).alias("n"), _rated_features(k, t, other).alias("f"))

        return F.transform(F.col(f"_v_{k}"), one)

    every = {"_more": F.concat(*[rated(k, n) for n, k in enumerate(KINDS)]), "_like": F.concat(*[like(k, n) for n, k in enumerate(KINDS)])}
    return df.withColumns(every).select("_row", "_base", "_more", "_like")


def tree_expression(node, f: Column) -> Column:
    """A regression tree of the fitted model as nested conditions."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    at = f[FEATURES[split.featureIndex()]] <= float(split.threshold())
    return F.when(at, tree_expression(node.leftChild(), f)).otherwise(tree_expression(node.rightChild(), f))


def _trees(model: GBTClassificationModel) -> list[tuple[float, object]]:
    return [(float(w), t.rootNode()) for w, t in zip(model.treeWeights, model._java_obj.trees(), strict=True)]


@dataclass
class Rater:
    """Trees and the threshold of each kind (None: nothing of it is added)."""

    trees: list[tuple[float, object]]
    thresholds: list[float | None]

    def margin(self, f: Column) -> Column:
        total = F.lit(0.0)
        for weight, root in self.trees:
            total = total + F.lit(weight) * tree_expression(root, f)
        return F.round(total, 3)  # thresholds are margins, so both are rounded; few different ones

    def chosen(self, x: Column) -> Column:
        ok = F.lit(False)
        for n, at in enumerate(self.thresholds):
            if at is not None:
                ok = ok | ((x["n"] == n) & (x["margin"] >= at))
        return ok


def thresholds(steps: list[tuple[int, float, float, int]]) -> list[float | None]:
    """The lowest margin above 0 of each kind from which its proposals are precise
    enough, given (kind, margin, good, all). A kind with few rows held back leans
    on what all kinds together show from that margin on, so none needs a least
    number of its own."""
    out: list[float | None] = [None] * len(KINDS)
    own = [[0.0, 0] for _ in KINDS]
    good = every = 0.0
    by_margin: dict[float, list] = {}
    for n, margin, g, a in steps:
        by_margin.setdefault(margin, []).append((n, g, a))
    for margin in sorted(by_margin, reverse=True):
        for n, g, a in by_margin[margin]:
            own[n][0], own[n][1] = own[n][0] + g, own[n][1] + a
            good, every = good + g, every + a
        if margin <= 0:
            break
        for n, (g, a) in enumerate(own):
            if a and (g + PRIOR_ROWS * good / every) / (a + PRIOR_ROWS) >= PRECISION:
                out[n] = margin
    return out


def fit(proposed: DataFrame, rows: int = SAMPLE) -> Rater:
    """Boosted trees on a bounded sample of three fifths of the proposals (of each
    kind and label those with the smallest hash), thresholds from all others."""
    each = proposed.select(F.explode("_more").alias("x")).select("x.n", "x.same", "x.other", "x.passes", "x.f")
    # found as another kind, or passing the check in another writing: no evidence
    each = each.where("same or not (other or passes)").drop("other", "passes")
    like = proposed.select(F.explode("_like").alias("x")).select("x.n", F.lit(True).alias("same"), "x.f")
    each = each.unionByName(like)
    each = each.withColumn("h", F.xxhash64("f", "same")).select("h", "n", F.col("same").cast("double").alias("label"), "f")
    train, rest = each.where("pmod(h, 5) < 3"), each.where("pmod(h, 5) >= 3")
    train = train.withColumn("at", F.pmod(F.xxhash64("h"), F.lit(SAMPLE_STEPS)))
    limit = rows // (2 * len(KINDS))
    parts = []
    for r in train.groupBy("n", "label").count().orderBy("n", "label").collect():  # two rows a kind
        part = train.where((F.col("n") == r["n"]) & (F.col("label") == r["label"]) & (F.col("at") < sample_cut(r["count"], limit)))
        parts.append(part.orderBy("at", "h").limit(limit))
    if not parts:
        return Rater([], [None] * len(KINDS))
    sample = stored(reduce(DataFrame.unionByName, parts).select("label", "f.*"), "pii-sample")
    if sample.select("label").distinct().count() < 2:
        return Rater([], [None] * len(KINDS))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=3, labelCol="label").fit(vectors.select("label", "features"))
    rater = Rater(_trees(model), [None] * len(KINDS))
    margins = rest.select("n", "label", rater.margin(F.col("f")).alias("margin")).groupBy("n", "margin").agg(F.sum("label").alias("good"), F.count("*").alias("all"))
    # a row for each kind and thousandth of a margin
    rater.thresholds = thresholds([(r["n"], r["margin"], r["good"], r["all"]) for r in margins.collect()])
    return rater


def _found(docs: DataFrame, text: str, keep_text: bool = True) -> DataFrame:
    """_row (the columns of ``docs``), base_spans and added_spans."""
    got = stored(proposals(docs, text, keep_text), "pii-proposals")
    rater = fit(got)
    free = F.filter("_more", lambda x: ~x["other"])
    rated = F.transform(free, lambda x: F.struct(x["n"].alias("n"), x["f"]["s"].alias("s"), x["f"]["e"].alias("e"), rater.margin(x["f"]).alias("margin")))
    got = got.withColumn("_rated", F.filter(rated, rater.chosen))

    def stays(x: Column) -> Column:
        def wins(y: Column) -> Column:
            better = (y["margin"] > x["margin"]) | ((y["margin"] == x["margin"]) & ((y["n"] < x["n"]) | ((y["n"] == x["n"]) & ((y["s"] < x["s"]) | ((y["s"] == x["s"]) & (y["e"] > x["e"]))))))
            return (y["s"] < x["e"]) & (y["e"] > x["s"]) & better

        return ~F.exists("_rated", wins)

    added = F.transform(F.filter("_rated", stays), lambda x: F.struct(x["n"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    return got.select("_row", F.col("_base").alias("base_spans"), F.array_sort(added).alias("added_spans"))


def find(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with base_spans and added_spans: arrays of (kind, s, e) in order."""
    return _found(docs.drop("base_spans", "added_spans"), text, keep_text).select("_row.*", "base_spans", "added_spans")


def _said(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    got = _found(docs, text)
    t = F.col("_row")[text]
    spans = F.transform(F.concat("base_spans", "added_spans"), lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("r"), x["kind"].alias("kind")))
    got = got.withColumn("spans", F.array_sort(spans))

    def cut(acc: Column, x: Column) -> Column:
        more = F.concat(acc["out"], F.substring(t, acc["n"] + 1, x["s"] - acc["n"]), F.element_at(names, x["kind"] + 1))
        fresh = x["s"] >= acc["n"]  # else it overlaps what is masked already
        return F.struct(F.greatest(acc["n"], -x["r"]).alias("n"), F.when(fresh, more).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit("").alias("out")), cut, lambda a: F.concat(a["out"], F.substring(t, a["n"] + 1, F.length(t))))
    masked = F.when(F.size("spans") > 0, clean).otherwise(t)
    return got.select(*[masked.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, base counts n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    got = find(docs.select("doc_id", "text"), keep_text=False)
    counts = [F.size(F.filter("base_spans", _is(n))).cast("long").alias(f"n_{k}") for n, k in enumerate(KINDS)]
    every = F.array_sort(F.concat("base_spans", "added_spans"))
    return got.select("doc_id", *counts, F.sha2(_said(F.col("base_spans")), 256).alias("base_sha256"), _said(every).alias("spans"), F.size("added_spans").cast("long").alias("n_added"))

"""Personal data: high-recall candidates, boosted trees, calibrated thresholds (DataFrame functions only).

Base spans come from strict patterns and checks. Beside them, generators propose overlapping candidates for the
same kinds: numbers grouped like phone numbers or cards wherever they stand, spelled-out e-mail
addresses, dotted quads. A candidate has format and context features, each a small integer, so all
candidates of a corpus fall into a bounded number of cells. Weak labels reach beyond the base patterns: an e-mail
address is plain or, spelled out or spaced, ends in a label of letters only; a phone number has a country code or a
word like "call" ahead; the others pass their strict check. The features do not contain these checks, but for the
words ahead of a phone number: national numbers are told from other numbers by them alone, so their
precision is held against that rule. Gradient-boosted trees are fitted on the counts of the cells, and each
kind's threshold is the lowest score whose precision on held-out documents is high enough.
The trees become one SQL expression. Selected candidates join the base spans.

Offsets are computed inside each row, from the lengths of matches and of the text between them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.session import scratch_path

KINDS = ("email", "ip", "card", "phone")
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: The contract's patterns. Possessive, and tried only where a leftmost match can start (after another kind of
#: character, or right behind the last match), so that long runs are read once.
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
AT, DOT = r"\x20?(?:@|[(\[]at[)\]])\x20?", r"(?:\.|\x20?[(\[]dot[)\]]\x20?)"
CANDIDATES = {
    "email": rf"(?<!{LOCAL}){LOCAL}++{AT}{LABEL}++(?:{DOT}{LABEL}++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{12,19}|[0-9]{4}(?:[\x20-][0-9]{4}){2,3})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+?[0-9]{1,3}[\x20.-])?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Texts without this have no match of the kind.
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{4}", "phone": "[0-9]{2}"}
BASE_NEEDS = {**NEEDS, "card": "[0-9]", "phone": r"\+[0-9]"}
CONTACT = "call|phone|tel|mobil|fax|cell|mail|contact|reach|kontakt|llam|appel"
CALLED = "(^|[^a-z])(call|phone|tel|mobil|fax|cell|contact|reach|kontakt|llam|appel)"
PAYMENT = "card|visa|credit|debit|konto|carte|tarjeta|account"
NEUTRAL = r"order|invoice|ref|\\bno\\b|\\bnr\\b|\\bid\\b|page|total|version|item|token|="
FEATURES = ("kind", "digits", "separator", "words", "before", "after", "prefix")
TREES, RATE, PRECISION, FOLDS = 40, 0.3, 0.9, 5


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once however often ``body`` names it."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _blocks(array: str, n: str) -> str:
    """An array cut into blocks of ``n``."""
    return f"transform(sequence(0, {n} - 1), b -> slice({array}, b * {n} + 1, {n}))"


def _ends(lengths: str) -> str:
    """Running sums of an array, in blocks of its square root: no quadratic work for texts with many matches."""
    total = "aggregate({}, 0L, (s, v) -> s + v)"
    within = _let("start", total.format("slice(z.sums, 1, b)"), f"transform(k, (x, j) -> start + {total.format('slice(k, 1, j + 1)')})")
    sums = _let("z", f"struct(w.k AS k, transform(w.k, k -> {total.format('k')}) AS sums)", f"flatten(transform(z.k, (k, b) -> {within}))")
    cut = _let("t", f"struct({lengths} AS l, CAST(ceil(sqrt(size({lengths}))) AS INT) AS n)", _let("w", f"struct({_blocks('t.l', 't.n')} AS k)", sums))
    return f"IF(size({lengths}) = 0, CAST(array() AS ARRAY<BIGINT>), {cut})"


def _matched(text: Column, pattern: str, needs: str) -> tuple[Column, Column]:
    """Matches of a pattern, and the text before, between and behind them."""
    there = text.rlike(needs)
    return (
        F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")),
        F.when(there, F.split(text, pattern)).otherwise(F.array().cast("array<string>")),
    )


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(x: str) -> str:
    """Whether the digits of x pass the Luhn check."""
    d = _digits(x)
    value = f"(ascii(substring({d}, char_length({d}) - i + 1, 1)) - 48)"
    twice = f"(2 * {value} - IF({value} > 4, 9, 0))"
    return f"(aggregate(sequence(1, char_length({d})), 0, (s, i) -> s + IF(i % 2 = 0, {twice}, {value})) % 10 = 0)"


def _check(kind: str, x: str) -> str:
    count = f"char_length({_digits(x)})"
    part = "regexp_replace(p, '^0+', '')"
    return {
        "email": "true",
        "ip": f"forall(split({x}, '[.]'), p -> char_length({part}) <= 3 AND coalesce(try_cast({part} AS INT), 0) <= 255)",
        "card": f"{count} BETWEEN 12 AND 19 AND {_luhn(x)}",
        "phone": f"{count} BETWEEN 9 AND 15",
    }[kind]


def _char_class(c: str) -> str:
    return f"CASE WHEN {c} = '' OR {c} rlike '[ \\\\t\\\\r\\\\n]' THEN 0 WHEN {c} rlike '[A-Za-z0-9_]' THEN 1 ELSE 2 END"


def _features(k: int, kind: str, m: str, g: str) -> str:
    """Struct of a candidate ``x`` at index ``i``: its kind, weak label and features."""
    count = f"char_length({_digits('x')})"
    ahead = f"lower(right(get({g}, i), 24))"
    label = {
        "email": "x rlike '^[^ (\\\\[]+@[^ (\\\\[]+$' OR x rlike '[^A-Za-z0-9-][A-Za-z]{2,}$'",
        "phone": f"left(x, 1) = '+' OR {ahead} rlike '{CALLED}'",
    }.get(kind, _check(kind, "x"))
    parts = {
        "kind": str(k),
        "digits": f"CASE WHEN {count} < 9 THEN 0 WHEN {count} <= 10 THEN 1 WHEN {count} <= 12 THEN 2 WHEN {count} <= 15 THEN 3 WHEN {count} = 16 THEN 4 ELSE 5 END",
        "separator": "CASE WHEN x rlike '[(.]' THEN 3 WHEN x rlike ' ' THEN 1 WHEN x rlike '-' THEN 2 ELSE 0 END",
        "words": f"CASE WHEN {ahead} rlike '{CONTACT}' THEN 1 WHEN {ahead} rlike '{PAYMENT}' THEN 2 WHEN {ahead} rlike '{NEUTRAL}' THEN 3 ELSE 0 END",
        "before": _char_class(f"right(get({g}, i), 1)"),
        "after": _char_class(f"left(get({g}, i + 1), 1)"),
        "prefix": f"IF({_digits('x')} rlike '^[3-6]', 1, 0)",
    }
    fields = ", ".join(f"CAST({v} AS TINYINT) AS {n}" for n, v in parts.items())
    return f"struct(get({m}_end, i) - char_length(x) AS start, get({m}_end, i) AS end, CAST({label} AS INT) AS label, {fields})"


def detect(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``row`` (a struct of the carried columns), ``base`` spans and ``candidates`` of each row's whole text."""
    d = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    names = [(f"{role}_{k}", k, rx, need) for role, patterns, needs in (("b", BASE, BASE_NEEDS), ("c", CANDIDATES, NEEDS)) for k, rx, need in ((k, patterns[k], needs[k]) for k in KINDS)]
    columns = ["row"]
    for n, _, rx, need in names:
        m, g = _matched(F.col("text"), rx, need)
        columns += [m.alias(n), g.alias(f"{n}_gap")]
    d = d.select(*columns)
    lengths = [F.expr(f"transform({n}, (x, i) -> CAST(char_length(x) + char_length(get({n}_gap, i)) AS BIGINT))").alias(f"{n}_len") for n, *_ in names]
    d = d.select("*", *lengths)
    d = d.select("*", *[F.expr(_ends(f"{n}_len")).alias(f"{n}_end") for n, *_ in names])
    base, candidates = [], []
    for n, kind, *_ in names:
        k = KINDS.index(kind)
        if n.startswith("b_"):
            spans = f"transform({n}, (x, i) -> struct(get({n}_end, i) - char_length(x) AS start, {k} AS kind, get({n}_end, i) AS end, x AS x))"
            base.append(f"transform(filter({spans}, y -> {_check(kind, 'y.x')}), y -> struct(y.start AS start, y.kind AS kind, y.end AS end))")
        else:
            candidates.append(f"transform({n}, (x, i) -> {_features(k, kind, n, f'{n}_gap')})")
    return d.select("row", F.expr(f"concat({', '.join(base)})").alias("base"), F.expr(f"concat({', '.join(candidates)})").alias("candidates"))


@dataclass(frozen=True)
class Split:
    """An inner node (feature, value, then, else) or a leaf (its score in ``value``)."""

    feature: int = -1
    value: float = 0.0
    then: Split | None = None
    other: Split | None = None

    def score(self, cell: tuple[int, ...]) -> float:
        if self.feature < 0:
            return self.value
        return (self.then if cell[self.feature] == self.value else self.other).score(cell)

    def sql(self, item: str) -> str:
        if self.feature < 0:
            return f"{self.value!r}D"
        return f"IF({item}.{FEATURES[self.feature]} = {int(self.value)}, {self.then.sql(item)}, {self.other.sql(item)})"


def _fit_tree(cells: list[tuple], depth: int) -> Split:
    """Newton tree over cells of (features, gradient, hessian)."""
    g, h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    leaf = Split(value=RATE * g / (h + 1.0))
    if not depth or len(cells) < 2:
        return leaf
    best, gain = None, g * g / (h + 1.0) + 1e-9
    for f in range(len(FEATURES)):
        sums: dict[int, list[float]] = {}
        for c in cells:
            s = sums.setdefault(c[0][f], [0.0, 0.0])
            s[0] += c[1]
            s[1] += c[2]
        for v, (gv, hv) in sorted(sums.items()):
            score = gv * gv / (hv + 1.0) + (g - gv) ** 2 / (h - hv + 1.0)
            if len(sums) > 1 and score > gain:
                best, gain = (f, v), score
    if best is None:
        return leaf
    f, v = best
    return Split(f, v, _fit_tree([c for c in cells if c[0][f] == v], depth - 1), _fit_tree([c for c in cells if c[0][f] != v], depth - 1))


@dataclass(frozen=True)
class Model:
    """Boosted trees over cells, and the score from which each kind's candidates are taken."""

    start: float
    trees: tuple[Split, ...]
    thresholds: tuple[float, ...]

    def score(self, cell: tuple[int, ...]) -> float:
        return self.start + sum(t.score(cell) for t in self.trees)

    def sql(self, item: str) -> str:
        return " + ".join([f"{self.start!r}D", *(t.sql(item) for t in self.trees)])


def fit(train: dict[tuple[int, ...], tuple[int, int]], held: dict[tuple[int, ...], tuple[int, int]]) -> Model:
    """From cell -> (positive, all) counts of training and held-out documents."""
    pos, n = (sum(c[i] for c in train.values()) for i in (0, 1))
    if not n:
        return Model(0.0, (), (math.inf,) * len(KINDS))
    start = math.log((pos + 1) / (n - pos + 1))
    scores, trees = dict.fromkeys(train, start), []
    for _ in range(TREES):
        p = {c: 1 / (1 + math.exp(-s)) for c, s in scores.items()}
        tree = _fit_tree([(c, train[c][0] - train[c][1] * p[c], train[c][1] * p[c] * (1 - p[c])) for c in sorted(train)], 3)
        trees.append(tree)
        for c in scores:
            scores[c] += tree.score(c)
    model = Model(start, tuple(trees), ())
    thresholds = []
    for k in range(len(KINDS)):
        best, hit, seen = math.inf, 0, 0
        ranked = sorted(((model.score(c), x) for c, x in held.items() if c[0] == k), reverse=True)
        for s, (a, b) in ranked:
            hit, seen = hit + a, seen + b
            if (hit + 1) / (seen + 2) >= PRECISION:
                best = s
        thresholds.append(best)
    return Model(start, tuple(trees), tuple(thresholds))


def train(found: DataFrame) -> Model:
    """The cells' counts are all that reaches the driver: at most the product of the features' values."""
    fold = F.pmod(F.xxhash64("row.doc_id"), F.lit(FOLDS)) == 0
    each = found.where(F.size("candidates") > 0).select(fold.alias("held"), F.explode("candidates").alias("c")).select("held", "c.*")
    counts = each.groupBy("held", *FEATURES).agg(F.sum("label").alias("pos"), F.count("*").alias("n")).collect()
    cells: tuple[dict, dict] = ({}, {})
    for r in counts:
        cells[bool(r["held"])][tuple(r[f] for f in FEATURES)] = (r["pos"], r["n"])
    return fit(*cells)


def select(found: DataFrame, model: Model) -> DataFrame:
    """``row``, ``base`` and ``spans``: base spans and taken candidates, each once, by start, kind and end."""
    thresholds = ", ".join("CAST('Infinity' AS DOUBLE)" if math.isinf(t) else f"{t - 1e-9!r}D" for t in model.thresholds)
    taken = f"transform(filter(candidates, c -> {model.sql('c')} >= get(array({thresholds}), CAST(c.kind AS INT))), c -> struct(c.start AS start, CAST(c.kind AS INT) AS kind, c.end AS end))"
    d = found.select("row", F.sort_array("base").alias("base"), F.expr(f"IF(size(candidates) = 0, base, sort_array(concat(base, {taken})))").alias("every"))
    return d.select("row", "base", F.expr("filter(every, (x, i) -> i = 0 OR NOT (x <=> get(every, i - 1)))").alias("spans"))


def find(spark: SparkSession, docs: DataFrame, carry: list[str]) -> DataFrame:
    """Detection is written once to the shared folder; training and selection read it."""
    path = scratch_path(spark, "pii")
    detect(docs, carry).write.parquet(path)
    found = spark.read.parquet(path)
    return select(found, train(found))


def _joined(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat(get(array({names}), x.kind), ':', x.start, ':', x.end)), ',')")


def personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of the table: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Offsets are code points, ends exclusive. Null and empty texts have no spans. Repeated rows each get a row.
    """
    counts = [F.expr(f"CAST(size(filter(base, x -> x.kind = {k})) AS BIGINT)").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return find(spark, docs, ["doc_id"]).select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"),
        *counts,
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"),
    )


def redacted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents, all columns, with each span (overlapping ones as one) replaced by its kind's name."""
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    # in blocks of spans, each with its own part of the text, so that long texts with many spans take no quadratic work
    block = _let(
        "c",
        "struct(get(y.at, b) AS at, substring(y.text, CAST(get(y.at, b) AS INT) + 1, CAST(get(y.tops, b) - get(y.at, b) AS INT)) AS text)",
        """aggregate(k, struct('' AS out, c.at AS at),
            (s, x) -> struct(
                IF(x.start >= s.at, concat(s.out, substring(c.text, CAST(s.at - c.at AS INT) + 1, CAST(x.start - s.at AS INT)), get(array(NAMES), x.kind)), s.out) AS out,
                greatest(s.at, x.end) AS at),
            s -> s.out)""".replace("NAMES", names),
    )
    # the text is replaced up to the largest end of a block and of those before it
    replaced = _let("z", "struct(w.text AS text, w.k AS k, transform(w.k, k -> array_max(transform(k, x -> x.end))) AS own)",
                _let("y", "struct(z.text AS text, z.k AS k, transform(z.k, (k, b) -> array_max(slice(z.own, 1, b + 1))) AS tops, "
                     "transform(z.k, (k, b) -> coalesce(array_max(slice(z.own, 1, b)), 0L)) AS at)",
                     f"concat(array_join(transform(y.k, (k, b) -> {block}), ''), substring(y.text, CAST(array_max(y.tops) AS INT) + 1))"))
    text = _let(
        "t",
        "struct(spans AS s, row.text AS text, CAST(ceil(sqrt(size(spans))) AS INT) AS n)",
        _let("w", f"struct(t.text AS text, filter({_blocks('t.s', 't.n')}, k -> size(k) > 0) AS k)", replaced),
    )
    d = find(spark, docs, docs.columns)
    d = d.select("row", F.expr(f"IF(size(spans) = 0, row.text, {text})").alias("_text"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_text").alias(c))
        elif c == "n_chars":
            columns.append(F.coalesce(F.char_length("_text").cast(docs.schema[c].dataType), F.col(f"row.`{c}`")).alias(c))
        else:
            columns.append(F.col(f"row.`{c}`").alias(c))
    return d.select(*columns)

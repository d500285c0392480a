"""Personal data: generators propose spans, boosted trees select among them.

Everything that touches documents is a column expression; only counts of distinct feature
combinations, of a bounded number, reach the driver for the fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import boosting
from quayside.llm.common import stage

KINDS = ["email", "ip", "card", "phone"]

# The base forms, written so that a match never tries a place twice. A match may
# only begin where a run of its characters begins or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without a match of this has no base match of the kind.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]"}

#: Further forms: (kind, pattern, what a text needs). They look at the text without the base spans.
WIDE = [
    (
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]++)++",
        r"[(\[]at[)\]]",
    ),
    ("ip", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"),
    ("card", r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", r"[0-9](?:[ -]?[0-9]){15}"),
    ("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2}(?![0-9])", r"\+[0-9]"),
    ("phone", r"(?<![0-9+().-])(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", r"[0-9]{3}[ .-][0-9]{4}"),
]

#: The wide form of a kind that is right by its own form: (what its matches are, a copy with one thing wrong).
#: Other wide forms have the check of the base form.
OWN_FORM = {"ip": (r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$", "concat(c.hit, ':', left(c.hit, 1))")}

CONTEXT_CHARS = 24
KEYWORDS = "(?i)mail|phone|tel|call|fax|card|visa|address|host|server|contact"
FEATURES = ["digits", "marks", "letters", "luhn", "octets", "last_label", "before", "after", "near_digits", "keyword", "lead"]
#: Distinct feature combinations that a kind's trees are fitted on; a fixed pseudo-random part of more.
MAX_CELLS = 20_000
#: Thresholds are multiples of one part in so many.
STEPS = 1000
#: A kind's threshold keeps spans right in this share of the calibration documents' ones.
PRECISION = 0.99
#: Documents with crc32(doc_id) modulo 5 of 0 calibrate; the trees are fitted on the others.
FOLDS = 5
_BLOCK = 512


def _starts(steps: str) -> str:
    """The running sum of an array of numbers before each of them, in blocks to stay near linear."""
    none, nones = "cast(array() AS array<int>)", "cast(array() AS array<array<int>>)"
    blocks = (
        f"transform(sequence(0, (size({steps}) - 1) div {_BLOCK}), k -> aggregate(slice({steps}, cast(k * {_BLOCK} + 1 AS int), {_BLOCK}), "
        f"named_struct('t', 0, 'a', {none}), (s, x) -> named_struct('t', s.t + x, 'a', array_append(s.a, s.t))))"
    )
    return (
        f"flatten(aggregate({blocks}, named_struct('t', 0, 'a', {nones}), (s, b) -> "
        f"named_struct('t', s.t + b.t, 'a', array_append(s.a, transform(b.a, v -> v + s.t)))).a)"
    )


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def _located(df: DataFrame, name: str, text: str, pattern: str, needs: str) -> DataFrame:
    """Adds `name`: where `pattern` matches in `text`, with the match and its context.

    Splitting at the matches gives what lies between them, and so their places, counted in
    characters.
    """
    gate = f"{text} RLIKE {_quoted(needs)}"
    between, hits, at = f"__between_{name}", f"__hits_{name}", f"__at_{name}"
    df = df.withColumns(
        {
            between: F.expr(f"CASE WHEN {gate} THEN split({text}, {_quoted(pattern)}, -1) ELSE array('') END"),
            hits: F.expr(f"CASE WHEN {gate} THEN regexp_extract_all({text}, {_quoted(pattern)}, 0) ELSE cast(array() AS array<string>) END"),
        }
    )
    steps = f"transform({between}, (x, i) -> length(x) + coalesce(length(get({hits}, i)), 0))"
    df = df.withColumn(f"__steps_{name}", F.expr(steps)).withColumn(at, F.expr(_starts(f"__steps_{name}")))
    found = (
        f"transform({hits}, (h, i) -> named_struct('start', get({at}, i) + length(get({between}, i)), "
        f"'stop', get({at}, i) + length(get({between}, i)) + length(h), 'hit', h, "
        f"'left', right(get({between}, i), {CONTEXT_CHARS}), 'right', left(get({between}, i + 1), {CONTEXT_CHARS})))"
    )
    return df.withColumn(name, F.expr(found)).drop(between, f"__steps_{name}", at)


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """1 if the check sum of a string of digits is a multiple of ten."""
    value = f"(ascii(substring(reverse({digits}), j, 1)) - 48)"
    twice = f"({value} * 2 - CASE WHEN {value} > 4 THEN 9 ELSE 0 END)"
    total = f"aggregate(sequence(1, length({digits})), 0, (a, j) -> a + CASE WHEN j % 2 = 1 THEN {value} ELSE {twice} END)"
    return f"CASE WHEN length({digits}) BETWEEN 13 AND 19 AND {total} % 10 = 0 THEN 1 ELSE 0 END"


def _octets(x: str) -> str:
    """1 if a string is four numbers of at most 255 between dots."""
    part = "regexp_replace(o, '^0+', '')"
    return (
        f"CASE WHEN {x} RLIKE r'^[0-9]+(\\.[0-9]+){{3}}$' AND forall(split({x}, r'\\.'), "
        f"o -> length({part}) <= 3 AND coalesce(try_cast({part} AS int), 0) <= 255) THEN 1 ELSE 0 END"
    )


def _class(x: str) -> str:
    return f"CASE WHEN {x} = '' OR {x} RLIKE r'\\s' THEN 0 WHEN {x} RLIKE r'\\p{{L}}' THEN 1 WHEN {x} RLIKE '[0-9]' THEN 2 ELSE 3 END"


def _valid(kind: str) -> str:
    """What the base form of a kind asks of its matches; c has the features."""
    return {
        "email": "true",
        "ip": "c.octets = 1",
        "card": "c.luhn = 1",
        "phone": "c.digits BETWEEN 9 AND 15",
    }[kind]


def _own_form(kind: str) -> str:
    """Whether a proposal is of a wide form that has a validity of its own."""
    return f"c.hit RLIKE {_quoted(OWN_FORM[kind][0])}" if kind in OWN_FORM else "false"


def _described(array: str) -> str:
    """The spans of an array with their features: of their form, and of the text around them."""
    digits = _digits("c.hit")
    features = {
        "digits": f"least(length({digits}), 40)",
        "marks": "least(length(regexp_replace(c.hit, '[A-Za-z0-9]', '')), 12)",
        "letters": "least(length(regexp_replace(c.hit, '[^A-Za-z]', '')), 24)",
        "luhn": _luhn(digits),
        "octets": _octets("c.hit"),
        "last_label": r"least(length(regexp_extract(c.hit, r'[.)\]] ?([A-Za-z]+)$', 1)), 12)",
        "before": _class("right(c.left, 1)"),
        "after": _class("left(c.right, 1)"),
        "near_digits": f"least(length({_digits('concat(c.left, c.right)')}), 8)",
        "keyword": f"CASE WHEN concat(c.left, ' ', c.right) RLIKE {_quoted(KEYWORDS)} THEN 1 ELSE 0 END",
        "lead": "CASE WHEN c.hit RLIKE '^[0-9]' THEN 0 WHEN c.hit RLIKE r'^\\+' THEN 1 WHEN c.hit RLIKE '^[A-Za-z]' THEN 2 ELSE 3 END",
    }
    fields = ", ".join(f"'{k}', {v}" for k, v in features.items())
    return f"transform({array}, c -> named_struct('start', c.start, 'stop', c.stop, 'hit', c.hit, 'left', c.left, 'right', c.right, {fields}))"


def _proposed(docs: DataFrame, text: Column) -> DataFrame:
    """Adds base_<kind>, the valid base spans, fail_<kind>, the other base matches, and wide_<kind>."""
    df = docs.withColumn("__text", F.coalesce(text.cast("string"), F.lit("")))
    for kind in KINDS:
        df = _located(df, f"all_{kind}", "__text", BASE[kind], NEEDS[kind])
        df = df.withColumn(f"all_{kind}", F.expr(_described(f"all_{kind}")))
        df = df.withColumns(
            {
                f"base_{kind}": F.expr(f"filter(all_{kind}, c -> {_valid(kind)})"),
                f"fail_{kind}": F.expr(f"filter(all_{kind}, c -> NOT ({_valid(kind)}))"),
                # The text with blanks for the base spans: what else is proposed does not meet them.
                f"__rest_{kind}": F.expr(
                    f"CASE WHEN exists(all_{kind}, c -> {_valid(kind)}) THEN array_join(transform("
                    f"split(__text, {_quoted(BASE[kind])}, -1), (x, i) -> concat(x, coalesce((SELECT_HIT), ''))), '') ELSE __text END".replace(
                        "(SELECT_HIT)",
                        f"CASE WHEN {_valid(kind).replace('c.', f'get(all_{kind}, i).')} "
                        f"THEN repeat(' ', length(get(__hits_all_{kind}, i))) ELSE get(__hits_all_{kind}, i) END",
                    )
                ),
            }
        )
        for n, (_, pattern, needs) in enumerate(w for w in WIDE if w[0] == kind):
            df = _located(df, f"wide_{kind}_{n}", f"__rest_{kind}", pattern, needs).drop(f"__hits_wide_{kind}_{n}")
        wide = ", ".join(f"wide_{kind}_{n}" for n in range(sum(w[0] == kind for w in WIDE)))
        df = df.withColumn(f"wide_{kind}", F.expr(_described(f"concat({wide})")))
        df = df.drop(f"all_{kind}", f"__hits_all_{kind}", f"__rest_{kind}", *wide.split(", "))
    return df


@dataclass
class Trees:
    """Boosted trees of a kind and the score from which on a span is taken."""

    trees: list
    least: float

    def sql(self) -> str:
        if not np.isfinite(self.least):
            return "false"
        return f"({boosting.to_sql(self.trees, [f'c.{f}' for f in FEATURES])}) >= {self.least - 1e-6:.6f}D"


def _spoiled(kind: str) -> str:
    """A base span with one thing wrong, as an example of what only looks like one."""
    wrong = {
        "email": "regexp_replace(c.hit, r'@.*$', concat('@', c.digits % 10))",
        "ip": "concat(c.hit, '99')",
        "card": "concat(left(c.hit, length(c.hit) - 1), (ascii(right(c.hit, 1)) - 47) % 10)",
        "phone": "left(c.hit, 6)",
    }[kind]
    return f"transform(base_{kind}, c -> named_struct('start', c.start, 'stop', c.stop, 'hit', {wrong}, 'left', c.left, 'right', c.right))"


def _spoiled_wide(kind: str) -> str:
    """The same for the wide form with a validity of its own."""
    wrong = OWN_FORM[kind][1] if kind in OWN_FORM else "c.hit"
    own = f"filter(wide_{kind}, c -> {_own_form(kind)})"
    return f"transform({own}, c -> named_struct('start', c.start, 'stop', c.stop, 'hit', {wrong}, 'left', c.left, 'right', c.right))"


def _calibration(cells: DataFrame, trees: dict[str, list]) -> DataFrame:
    """kind, step, right and total: sums of all calibration cells by steps of their score, whose range is bounded."""
    columns = [f"c.{f}" for f in FEATURES]
    score = " ".join(f"WHEN kind = '{k}' THEN {boosting.to_sql(t, columns)}" for k, t in trees.items())
    held = cells.filter("calibrates").select("kind", "label", "n", F.struct(*FEATURES).alias("c"))
    # find_spans takes scores down to 1e-6 below the threshold.
    held = held.withColumn("step", F.expr(f"floor((CASE {score} END + 1e-6D) * {STEPS})"))
    return held.groupBy("kind", "step").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("total"))


def fit(docs: DataFrame) -> dict[str, Trees]:
    """Trees and thresholds per kind from the proposals in all of `docs`.

    Labels come from the forms themselves: base spans, and IPv6 addresses of eight groups, that
    stand free of letters and digits are right; base matches that fail their check, proposals of
    the other wide forms that fail it and spoiled copies of the right ones are wrong. Rows with equal features are one cell with a count,
    so what is fitted on does not grow with the documents; of more than MAX_CELLS cells of a kind
    the smallest by hash are taken. Thresholds come from all cells of the calibration documents.
    """
    df = _proposed(docs.select("doc_id", "text"), F.col("text"))
    fold = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)), F.lit(1)) == 0
    labelled = []
    for kind in KINDS:
        free = "c.before IN (0, 3) AND c.after IN (0, 3)"
        strip = lambda a, label: f"transform({a}, c -> named_struct('kind', '{kind}', 'label', {label}, {', '.join(f'{chr(39)}{x}{chr(39)}, c.{x}' for x in FEATURES)}))"
        labelled += [
            strip(f"base_{kind}", f"CASE WHEN {free} THEN 1 ELSE 0 END"),
            strip(f"fail_{kind}", "0"),
            strip(_described(_spoiled(kind)), "0"),
            strip(f"filter(wide_{kind}, c -> {_own_form(kind)})", f"CASE WHEN {free} THEN 1 ELSE 0 END"),
            strip(f"filter(wide_{kind}, c -> NOT ({_valid(kind)}) AND NOT ({_own_form(kind)}))", "0"),
            *([strip(_described(_spoiled_wide(kind)), "0")] if kind in OWN_FORM else []),
        ]
    cells = (
        df.select(fold.alias("calibrates"), F.explode(F.expr(f"concat({', '.join(labelled)})")).alias("c"))
        .groupBy("calibrates", "c.kind", "c.label", *(f"c.{f}" for f in FEATURES))
        .agg(F.count("*").alias("n"))
    )
    cells = stage(cells, "pii-cells")
    trees = {}
    for kind in KINDS:
        fitting = cells.filter((F.col("kind") == kind) & ~F.col("calibrates"))
        mine = fitting.orderBy(F.xxhash64("label", *FEATURES), *FEATURES, "label").limit(MAX_CELLS).collect()
        x = np.array([[r[f] for f in FEATURES] for r in mine], np.int64).reshape(-1, len(FEATURES))
        trees[kind] = boosting.fit(x, np.array([r["label"] for r in mine], float), np.array([r["n"] for r in mine], float))
    sums = _calibration(cells, trees).collect()
    models = {}
    for kind in KINDS:
        mine = [r for r in sums if r["kind"] == kind]
        right, total = (np.array([r[k] for r in mine], float) for k in ("right", "total"))
        score = np.array([r["step"] for r in mine], float) / STEPS
        models[kind] = Trees(trees[kind], boosting.threshold(score, right / np.maximum(total, 1), total, PRECISION))
    return models


def find_spans(docs: DataFrame, models: dict[str, Trees]) -> DataFrame:
    """The rows of `docs` with base_<kind> and added_<kind>, arrays of spans (start, stop), in order.

    Base spans always stay. Other proposals are added where the trees score them at the threshold
    or above; of those that overlap, the first and of these the longest stays. Null texts are
    empty. There is no shuffle; each row gives one row.
    """
    names = docs.columns
    df = _proposed(docs, F.col("text"))
    none = "cast(array() AS array<struct<start: int, stop: int>>)"
    span = "named_struct('start', c.start, 'stop', c.stop)"
    for kind in KINDS:
        taken = f"transform(filter(concat(wide_{kind}, fail_{kind}), c -> {models[kind].sql()}), c -> named_struct('start', c.start, 'back', -c.stop))"
        apart = (
            f"aggregate(array_sort({taken}), {none}, (s, c) -> CASE WHEN size(s) = 0 OR element_at(s, -1).stop <= c.start "
            f"THEN array_append(s, named_struct('start', c.start, 'stop', -c.back)) ELSE s END)"
        )
        df = df.withColumn(f"added_{kind}", F.expr(apart)).withColumn(f"base_{kind}", F.expr(f"transform(base_{kind}, c -> {span})"))
    return df.select(*names, "__text", *(f"{part}_{k}" for k in KINDS for part in ("base", "added")))


def _listed(arrays: list[tuple[str, str]]) -> Column:
    parts = ", ".join(f"transform({a}, c -> concat('{kind}:', c.start, ':', c.stop))" for kind, a in arrays)
    return F.expr(f"array_join(concat({parts}), ',')")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added for each row of `docs`.

    n_* count the base spans; base_sha256 is the SHA-256 of their list, kind:start:end by kind and
    start, comma-joined, in code points with the end exclusive. spans lists them together with the
    spans that the trees add, n_added. Null and empty texts have none; rows that are repeated and
    rows without doc_id are rows like others; other columns are ignored.
    """
    found = find_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs))
    every = [(k, f"array_sort(concat(base_{k}, added_{k}))") for k in KINDS]
    return found.select(
        "doc_id",
        *(F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed([(k, f"base_{k}") for k in KINDS]), 256).alias("base_sha256"),
        _listed(every).alias("spans"),
        sum((F.size(f"added_{k}") for k in KINDS), F.lit(0)).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with [EMAIL], [IP], [CARD] and [PHONE] in place of the spans in text.

    Overlapping spans become one mark, of the first one's kind; n_chars, if there, is the new
    length. Null texts stay null; texts without a span stay as they are. Each row gives one row; the
    other columns come back unchanged, whatever their names.
    """
    names = docs.columns
    found = find_spans(docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("row"), "text"), fit(docs))
    spans = ", ".join(
        f"transform(concat(base_{k}, added_{k}), c -> named_struct('start', c.start, 'stop', c.stop, 'mark', '[{k.upper()}]'))" for k in KINDS
    )
    found = found.withColumn("__spans", F.expr(f"array_sort(concat({spans}))"))
    built = (
        "aggregate(__spans, named_struct('at', 0, 'parts', cast(array() AS array<string>)), (s, c) -> CASE WHEN c.start >= s.at "
        "THEN named_struct('at', c.stop, 'parts', concat(s.parts, array(substring(__text, s.at + 1, c.start - s.at), c.mark))) "
        "ELSE named_struct('at', greatest(s.at, c.stop), 'parts', s.parts) END, "
        "s -> concat(array_join(s.parts, ''), substring(__text, s.at + 1)))"
    )
    found = found.withColumn("__redacted", F.expr(f"CASE WHEN size(__spans) = 0 THEN text ELSE {built} END"))
    made = {"text": F.col("__redacted")}
    if "n_chars" in names:
        made["n_chars"] = F.coalesce(F.length("__redacted").cast("long"), F.col("row.n_chars"))
    return found.select(*(made[n].alias(n) if n in made else F.col(f"row.`{n}`").alias(n) for n in names))

"""Secret scans by sliding-window Shannon entropy, DataFrame functions only.

Base spans come from three fixed patterns. The method adds one span for each
candidate string (a maximal run of 20 or more of A-Z a-z 0-9 + / _ = -, with a digit
and a letter, or letters of both cases) in which some window of 20 characters has an entropy at or above the
limit of its character class. The window's entropy is kept by incremental counts: with
S = sum(n * log2(n)) over the counts n in the window, each step adds the entering and
takes away the leaving character's share, and H = log2(20) - S / 20. Candidates are suppressed
where an allow-list pattern matches their value (what follows the last equals sign), and
windows where they hold a word of examples.

Null text counts as empty. The time grows with a text's length, whether it holds one very
long candidate or very many short ones. Rows are independent, so repeated rows, ties and
empty tables need no care; a column of the result's name is replaced, others are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomseq.llm.common import table

# Fixed values of the base scan.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

RUN = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Entropy limits in bits for a window of 20 characters, by character class.
LIMITS = {"hex": 2.95, "alnum": 3.71, "base64": 3.81, "letters": 4.05}
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9+/_=-]*$",
    r"^[A-Za-z]([A-Za-z_/=-]*[A-Za-z])?[0-9]{1,4}$",
)
#: Words of examples: no window that holds one is looked at.
WORDS = r"(?i)(example|sample|placeholder|changeme|dummy|deadbeef|xxxx|0123456789|abcdefgh)"
#: Items that are worked on together where positions are summed up.
BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.transform(F.array(value), use)[0]


def _blocks(items: Column) -> Column:
    """An array in arrays of BLOCK items, so that what grows inside one stays small."""
    count = F.greatest(F.ceil(F.size(items) / BLOCK).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(items, b * BLOCK + 1, BLOCK))


def _hits(text: Column, pattern: str) -> Column:
    """array<struct<start, hit>> of the leftmost non-overlapping matches. The lengths of
    matches and of the pieces between them add up to the positions, in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.slice(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit")), 1, F.size(hits))
    empty = "cast(array() as array<struct<start:int,hit:string>>)"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        hit = F.struct(start.alias("start"), x["hit"].alias("hit"))
        return F.struct((start + F.length(x["hit"])).alias("at"), F.concat(acc["found"], F.array(hit)).alias("found"))

    def inside(block: Column, before: Column) -> Column:
        return F.aggregate(block, F.struct(before.alias("at"), F.expr(empty).alias("found")), step)["found"]

    def place(blocks: Column) -> Column:
        length = lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["hit"]))
        before = lambda lengths, b: F.aggregate(F.slice(lengths, 1, b), F.lit(0), lambda n, x: n + x)
        return let(F.transform(blocks, length), lambda lengths: F.flatten(F.transform(blocks, lambda block, b: inside(block, before(lengths, b)))))

    return F.when(text.rlike(pattern), let(zipped, lambda z: let(_blocks(z), place))).otherwise(F.expr(empty))


def _spans(hits: Column, kind: int) -> Column:
    return F.transform(hits, lambda h: F.struct(h["start"].alias("start"), F.lit(kind).alias("kind"), (h["start"] + F.length(h["hit"])).alias("end")))


def _share(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def peak_entropy(s: Column, width: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of any window of width characters of s; -1 where
    s is shorter. The state is the window; a step takes away the share of the leaving
    character's count and adds that of the entering one's."""
    start = F.expr("named_struct('held', '', 's', 0.0D, 'best', -1.0D)")
    among = lambda c, held: F.length(held) - F.length(F.replace(held, c, F.lit("")))

    def step(acc: Column, c: Column) -> Column:
        full = F.length(acc["held"]) == width
        out = among(F.left(acc["held"], F.lit(1)), acc["held"])
        rest = F.when(full, F.substring(acc["held"], 2, width)).otherwise(acc["held"])
        less = F.when(full, acc["s"] + (_share(out - 1) - _share(out))).otherwise(acc["s"])
        n = among(c, rest)
        total = less + (_share(n + 1) - _share(n))
        held = F.concat(rest, c)
        best = F.when(F.length(held) == width, F.greatest(acc["best"], F.log2(F.lit(float(width))) - total / width)).otherwise(acc["best"])
        return F.struct(held.alias("held"), total.alias("s"), best.alias("best"))

    chars = F.filter(F.split(s, ""), lambda c: c != "")
    return F.when(F.length(s) >= width, F.aggregate(chars, start, step)["best"]).otherwise(F.lit(-1.0))


def _suspicious(s: Column) -> Column:
    """Letters alone are judged only in mixed case. The value is what follows the last equals
    sign, so that a key's name does not excuse it; it is looked at between words of examples,
    which so excuse themselves and not a key beside them."""
    digits, alnum = s.rlike("[0-9]"), s.rlike("^[A-Za-z0-9]+$")
    limit = F.when(s.rlike("^[0-9a-fA-F]+$"), LIMITS["hex"]).when(~digits, LIMITS["letters"]).when(alnum, LIMITS["alnum"]).otherwise(LIMITS["base64"])
    value = F.substring_index(F.rtrim(s, F.lit("=")), "=", -1)
    allowed = F.lit(False)
    for p in ALLOW:
        allowed = allowed | value.rlike(p)
    judged = (digits & s.rlike("[A-Za-z]")) | (s.rlike("[A-Z]") & s.rlike("[a-z]"))
    return F.when(judged & ~allowed, F.exists(F.split(value, WORDS, -1), lambda part: peak_entropy(part) >= limit)).otherwise(False)


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secret_spans") -> DataFrame:
    """Adds out: array<struct<start, kind, end>>, sorted; kind indexes KINDS, positions
    are code points, the end is exclusive. A span per match and kind; spans of different
    kinds may overlap. Null or empty text has none."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    assign = F.filter(_hits(t, ASSIGN), lambda h: F.length(F.regexp_extract(h["hit"], ASSIGN, 2)) >= 6)
    entropy = F.filter(_hits(t, RUN), lambda h: _suspicious(h["hit"]))
    found = F.concat(_spans(assign, 0), _spans(_hits(t, ACCESS), 1), _spans(_hits(t, HEX), 2), _spans(entropy, 3))
    return docs.withColumn(out, F.array_sort(found))


def render(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """text with every span (sorted, as find_secrets gives them) replaced; spans that overlap
    or touch count as one. Spans are worked on in blocks, each on its own part of the text."""

    def inside(block: Column, before: Column, stop: Column) -> Column:
        base = F.greatest(before, F.lit(0))

        def use(part: Column) -> Column:
            def step(acc: Column, s: Column) -> Column:
                gap = part.substr(F.greatest(acc["at"], F.lit(0)) - base + 1, s["start"] - F.greatest(acc["at"], F.lit(0)))
                done = F.when(s["start"] <= acc["at"], acc["done"]).otherwise(F.concat(acc["done"], gap, F.lit(mark)))
                return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), done.alias("done"))

            return F.aggregate(block, F.struct(before.alias("at"), F.lit("").alias("done")), step)["done"]

        return let(text.substr(base + 1, stop - base), use)

    def join(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda block: F.aggregate(block, F.lit(-1), lambda n, s: F.greatest(n, s["end"])))

        def pieces(ends: Column) -> Column:
            upto = lambda b: F.aggregate(F.slice(ends, 1, b), F.lit(-1), lambda n, e: F.greatest(n, e))
            changed = F.transform(blocks, lambda block, b: inside(block, upto(b), upto(b + 1)))
            return F.concat(F.array_join(changed, ""), text.substr(F.array_max(ends) + 1, F.length(text)))

        return let(ends, pieces)

    return F.when(F.size(spans) > 0, let(_blocks(spans), join)).otherwise(text)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    s = F.col("secret_spans")
    of = lambda k: F.size(F.filter(s, lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(render(F.filter(s, lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        render(s).alias("spans"),
    )


def _sql_hits(name: str, pattern: str, source: str) -> str:
    p = pattern.replace("'", "''")
    return f"""{name}_m AS (SELECT rid, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}') AS hits FROM {source} WHERE regexp_matches(text, '{p}')),
{name}_p AS (SELECT rid, unnest(generate_series(1, len(hits))) AS k, gaps, hits FROM {name}_m),
{name} AS (SELECT rid, hits[k] AS hit, (list_sum(list_transform(gaps[1:k], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:k-1], lambda h: length(h))), 0))::BIGINT AS s FROM {name}_p)"""


_NOT_ALLOWED = " AND ".join("NOT regexp_matches(v, '{}')".format(p) for p in ALLOW)
SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
{_sql_hits("a", ASSIGN, "d")},
{_sql_hits("b", ACCESS, "d")},
{_sql_hits("c", HEX, "d")},
{_sql_hits("e", RUN, "d")},
e_v AS (SELECT rid, hit, s, split_part(rtrim(hit, '='), '=', -1) AS v FROM e),
e_ok AS (SELECT rid, hit, s, string_split_regex(v, '{WORDS}') AS parts, CASE WHEN regexp_full_match(hit, '[0-9a-fA-F]+') THEN {LIMITS["hex"]} WHEN NOT regexp_matches(hit, '[0-9]') THEN {LIMITS["letters"]}
    WHEN regexp_full_match(hit, '[A-Za-z0-9]+') THEN {LIMITS["alnum"]} ELSE {LIMITS["base64"]} END AS lim
  FROM e_v WHERE (regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') OR regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]')) AND {_NOT_ALLOWED}),
f AS (SELECT rid, hit, s FROM e_ok WHERE list_max(flatten(list_transform(parts, lambda v: list_transform(generate_series(1, length(v) - {WINDOW - 1}), lambda i: list_entropy(string_split(substr(v, i, {WINDOW}), '')))))) >= lim),
x AS (SELECT rid, 0 AS k, s, s + length(hit) AS t FROM a WHERE length(regexp_extract(hit, '{ASSIGN.replace("'", "''")}', 2)) >= 6
  UNION ALL SELECT rid, 1, s, s + length(hit) FROM b UNION ALL SELECT rid, 2, s, s + length(hit) FROM c UNION ALL SELECT rid, 3, s, s + length(hit) FROM f),
y AS (SELECT rid, k, s, (['assign', 'access', 'hex', 'entropy'])[k + 1] || ':' || s || ':' || t AS z FROM x),
g AS (SELECT rid, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
  string_agg(z, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(z, ',' ORDER BY s, k) AS spans FROM y GROUP BY rid)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)"""

"""Queries of the sequence and text functions over the test tables. Document texts,
letters only, stand for parent sequences; their source is the source group, their
language the class; benchmark texts stand for the reference."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomseq.functions import packed as P
from loomseq.functions import sequences as S
from loomseq.functions import text as T
from loomseq.operators.windows import source_rank
from loomseq.plans.registry import query, spread, table
from loomseq.storage import stored

PARENTS = "(SELECT doc_id, source, lang, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS seq FROM documents)"
#: The 26 letters as bases, cyclically.
BASES = ("ACGT" * 7)[:26]
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parents(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    return docs.select("doc_id", "source", "lang", S.letters_only(F.col("text")).alias("seq"))


def links(spark, sf_dir):
    """doc_id, wt_id: each document and the one before it in its source. Only ids are ranked."""
    ids = table(spark, sf_dir, "documents").select("doc_id", "source")
    ranked = stored(spark, source_rank(ids, ["source"], ["doc_id"], "n"), "ranked")
    before = ranked.select("source", (F.col("n") + 1).alias("n"), F.col("doc_id").alias("wt_id"))
    return ranked.join(before, ["source", "n"]).select("doc_id", "wt_id")


def pairs(spark, sf_dir):
    """Each document with the one before it in its source, as mutant and wild type. Texts are
    joined to the pairs by id."""
    p = parents(spark, sf_dir)
    return p.join(links(spark, sf_dir), "doc_id").join(p.select(F.col("doc_id").alias("wt_id"), F.col("seq").alias("wt")), "wt_id").drop("wt_id")


PAIRS = f"(SELECT * FROM (SELECT *, lag(seq) OVER (PARTITION BY source ORDER BY doc_id) AS wt FROM {PARENTS}) WHERE wt IS NOT NULL)"
DNA = f"(SELECT doc_id, source, translate(seq, '{LETTERS}', '{BASES}') AS dna FROM {PARENTS})"


@query(
    "f1_kmer_tiling",
    f"""SELECT doc_id, k AS pep_len, count(*) AS n_windows, count(DISTINCT pep) AS n_distinct, min(pep) AS first_pep, max(pep) AS last_pep
FROM (SELECT doc_id, k, unnest(list_transform(generate_series(1, length(seq) - k + 1), lambda p: substr(seq, p::BIGINT, k))) AS pep FROM {PARENTS}, (SELECT unnest([9, 15]) AS k)) GROUP BY ALL""",
)
def f1(spark, sf_dir):
    return P.window_facts(parents(spark, sf_dir), "seq", [9, 15], "doc_id")


@query("p23_scale_gate", f"SELECT lang, sum(greatest(length(seq) - 7, 0) + greatest(length(seq) - 8, 0) + greatest(length(seq) - 14, 0))::BIGINT AS n_windows, sum(greatest(length(seq) - 7, 0) + greatest(length(seq) - 8, 0) + greatest(length(seq) - 14, 0)) > 200000 AS over_limit FROM {PARENTS} GROUP BY lang")
def p23(spark, sf_dir):
    n = F.sum(S.window_total(F.col("seq"), [8, 9, 15]))
    return parents(spark, sf_dir).groupBy("lang").agg(n.alias("n_windows")).withColumn("over_limit", F.col("n_windows") > 200_000)


HEAD = "('r' || doc_id || CASE doc_id % 4 WHEN 0 THEN '/1' WHEN 1 THEN '.2' WHEN 2 THEN ' 1:N:0' ELSE '' END || '|YP:' || source || ',' || lang || ', ,' || source || '|LEN:' || n_chars)"


def headers(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 4
    mate = F.when(k == 0, "/1").when(k == 1, ".2").when(k == 2, " 1:N:0").otherwise("")
    head = F.concat(F.lit("r"), "doc_id", mate, F.lit("|YP:"), "source", F.lit(","), "lang", F.lit(", ,"), "source", F.lit("|LEN:"), "n_chars")
    return d.select("doc_id", head.alias("header"))


@query("f2_header_tags", f"SELECT doc_id, array_to_string(list_sort(list_distinct([(SELECT source), (SELECT lang)])), ';') AS taxa, n_chars::VARCHAR AS len_tag FROM (SELECT doc_id, source, lang, n_chars FROM documents)")
def f2(spark, sf_dir):
    h = headers(spark, sf_dir)
    return h.select("doc_id", F.array_join(T.tag_list(F.col("header"), "YP"), ";").alias("taxa"), T.tag(F.col("header"), "LEN").alias("len_tag"))


@query("f3_fragment_identity", f"SELECT doc_id, 'r' || doc_id AS fragment, CASE doc_id % 4 WHEN 0 THEN 'slash' WHEN 1 THEN 'dot' WHEN 2 THEN 'comment' ELSE 'none' END AS status FROM documents")
def f3(spark, sf_dir):
    h = headers(spark, sf_dir)
    return h.select("doc_id", T.fragment_id(F.col("header")).alias("fragment"), T.fragment_status(F.regexp_replace("header", r"\|.*$", " ")).alias("status"))


@query("f4_source_groups", "SELECT doc_id, substr(sha256(array_to_string(list_sort(list_distinct([trim(source), trim(lang)])), ';')), 1, 20) AS source_group FROM documents")
def f4(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.group_id(F.array("source", "lang", F.lit(""), "source")).alias("source_group"))


@query("f5_content_digests", f"SELECT doc_id, 'P' || substr(sha256(lang || '|' || seq), 1, 16) AS record_id, md5(seq) AS seq_md5, sha256(seq) AS seq_sha FROM {PARENTS}")
def f5(spark, sf_dir):
    p = parents(spark, sf_dir)
    return p.select("doc_id", T.content_id("P", 16, F.col("lang"), F.col("seq")).alias("record_id"), F.md5("seq").alias("seq_md5"), F.sha2("seq", 256).alias("seq_sha"))


@query(
    "f6_hla_names",
    "SELECT p_partkey, 'A*' || lpad((p_size % 90)::VARCHAR, 2, '0') || ':01' AS two_field, 'DPA10103DPB1' || lpad((p_size % 90)::VARCHAR, 2, '0') || '01' AS support, 'B*' || lpad((p_size % 90)::VARCHAR, 2, '0') || ':07' AS compact FROM part",
)
def f6(spark, sf_dir):
    n = F.lpad((F.col("p_size") % 90).cast("string"), 2, "0")
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("HLA-DPA1*01:03/A*"), n, F.lit(":01:02:03N")).alias("long"), F.concat(F.lit("HLA-DPA1*01:03-DPB1*"), n, F.lit(":01")).alias("pair"), F.concat(F.lit("HLA-B"), n, F.lit("07")).alias("short"))
    return p.select("p_partkey", T.hla_two_field(F.col("long")).alias("two_field"), T.support_key(F.col("pair")).alias("support"), T.compact_hla(F.col("short")).alias("compact"))


_AMINO = f"substr('{S.CODON_AMINO}', (instr('TCAG', substr(dna, i * 3 - 2, 1)) - 1) * 16 + (instr('TCAG', substr(dna, i * 3 - 1, 1)) - 1) * 4 + instr('TCAG', substr(dna, i * 3, 1)), 1)"


@query(
    "f7_codon_translation",
    f"""SELECT doc_id, length(aa) AS n_aa, md5(aa) AS aa_md5, md5(translate(reverse(dna), 'ACGT', 'TGCA')) AS rc_md5 FROM (
SELECT doc_id, dna, regexp_replace(coalesce(array_to_string(list_transform(generate_series(1, length(dna) // 3), lambda i: {_AMINO}), ''), ''), '\\*$', '') AS aa FROM (SELECT doc_id, dna FROM {DNA}))""",
)
def f7(spark, sf_dir):
    p = parents(spark, sf_dir).select("doc_id", F.translate("seq", LETTERS, BASES).alias("dna"))
    aa = p.withColumn("aa", S.translate_codons(F.col("dna")))
    return aa.select("doc_id", F.length("aa").alias("n_aa"), F.md5("aa").alias("aa_md5"), F.md5(S.reverse_complement(F.col("dna"))).alias("rc_md5"))


@query("f9_base_names", "SELECT c_custkey, 'T' || c_custkey AS base FROM customer")
def f9(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 3
    tail = F.when(k == 0, F.concat(F.lit(".3.p"), "c_nationkey")).when(k == 1, F.concat(F.lit("."), "c_nationkey")).otherwise("-2")
    return c.select("c_custkey", T.base_name(F.concat(F.lit("T"), "c_custkey", tail)).alias("base"))


@query(
    "f10_centred_context",
    f"""SELECT doc_id, CASE WHEN a > 0 THEN substr(seq, greatest(1, least(a - 9, length(seq) - 26)), 27) END AS context FROM (SELECT doc_id, seq, part, instr(seq, part) AS a FROM (SELECT doc_id, seq, substr(seq, (length(seq) // 2 + 1)::BIGINT, 9) AS part FROM {PARENTS}) WHERE length(part) = 9)""",
)
def f10(spark, sf_dir):
    p = parents(spark, sf_dir).withColumn("part", F.expr("substr(seq, cast(floor(length(seq) / 2) as int) + 1, 9)")).where(F.length("part") == 9)
    return p.select("doc_id", S.centred_context(F.col("seq"), F.col("part")).alias("context"))


_PREFIX = "list_max(list_filter(generate_series(0, least(length({0}), length({1}))), lambda k: left({0}, k::BIGINT) = left({1}, k::BIGINT)))"
_REGION = f"(SELECT doc_id, source, seq, wt, {_PREFIX.format('seq', 'wt')} AS prefix, {_PREFIX.format('rs', 'rw')} AS sfx FROM (SELECT *, reverse(seq) AS rs, reverse(wt) AS rw FROM {PAIRS}))"


@query(
    "f11_changed_region",
    f"SELECT doc_id, prefix::INTEGER AS prefix, (CASE WHEN doc_id % 5 = 0 THEN 0 ELSE least(sfx, least(length(seq), length(wt)) - prefix) END)::INTEGER AS suffix FROM {_REGION}",
)
def f11(spark, sf_dir):
    p = pairs(spark, sf_dir).withColumn("r", S.changed_region(F.col("wt"), F.col("seq"), F.col("doc_id") % 5 == 0))
    return p.select("doc_id", F.col("r.prefix").cast("int").alias("prefix"), F.col("r.suffix").cast("int").alias("suffix"))


@query(
    "f13_mutation_windows",
    f"""SELECT doc_id, count(*) AS n_windows, count(*) FILTER (wt_pep = mt_pep) AS n_same FROM (
SELECT doc_id, substr(seq, s, 9) AS mt_pep, substr(wt, s, 9) AS wt_pep, s, prefix, mt_end FROM (
SELECT *, unnest(generate_series(1, length(seq) - 8)) AS s FROM (SELECT *, length(seq) - least(sfx, least(length(seq), length(wt)) - prefix) AS mt_end FROM {_REGION})))
WHERE CASE WHEN mt_end > prefix THEN s <= mt_end AND s + 8 > prefix ELSE s <= prefix AND s + 8 > prefix END GROUP BY doc_id""",
)
def f13(spark, sf_dir):
    p = pairs(spark, sf_dir).withColumn("r", S.changed_region(F.col("wt"), F.col("seq"), F.lit(False)))
    return S.covered_counts(p.select("doc_id", "seq", "wt", "r.prefix", "r.mt_end"), "doc_id", "seq", "wt", 9)


@query(
    "f16_mutant_fragments",
    f"""SELECT doc_id, md5(CASE doc_id % 4 WHEN 0 THEN left(seq, p - 1) || 'WC' || substr(seq, p + 2) WHEN 1 THEN left(seq, p - 1) || 'WC' || substr(seq, p) WHEN 2 THEN left(seq, p - 1) || substr(seq, p + 3) ELSE left(seq, p - 1) || 'WC' END) AS mutant
FROM (SELECT doc_id, seq, (length(seq) // 2 + 1)::BIGINT AS p FROM {PARENTS})""",
)
def f16(spark, sf_dir):
    kinds = F.array(*[F.lit(k) for k in ("missense", "ins", "del", "FS")])
    p = parents(spark, sf_dir).withColumn("p", F.floor(F.length("seq") / 2).cast("int") + 1)
    m = S.fragment_of_variant(F.col("seq"), F.get(kinds, (F.col("doc_id") % 4).cast("int")), F.col("p"), F.lit("WC"), F.lit(3))
    return p.select("doc_id", F.md5(m).alias("mutant"))


def _scale_sql(scale):
    return " + ".join(f"(length(seq) - length(replace(seq, '{a}', ''))) * ({v})" for a, v in scale.items())


def _charge_sql(ph, constants):
    n = lambda c: "1" if c in "nc" else f"(length(seq) - length(replace(seq, '{c}', '')))"
    terms = [f"{sign} * {n(c)} / (1 + pow(10.0::DOUBLE, {sign} * ({ph} - {pk}::DOUBLE)))" for sign, group in zip((1, -1), constants, strict=True) for c, pk in group.items()]
    return " + ".join(terms)


# The small addend keeps values that lie between two roundings from going either way.
_MEAN = "round(({})::DOUBLE / nullif(length(seq), 0) + 1e-9, 6)"


@query(
    "f17_peptide_features",
    f"""WITH RECURSIVE p AS (SELECT doc_id, seq FROM {PARENTS}),
b AS (SELECT doc_id, seq, 0.0::DOUBLE AS lo, 14.0::DOUBLE AS hi, 0 AS step FROM p
  UNION ALL SELECT doc_id, seq, CASE WHEN {_charge_sql("((lo + hi) / 2)", S.EMBOSS)} > 0 THEN (lo + hi) / 2 ELSE lo END, CASE WHEN {_charge_sql("((lo + hi) / 2)", S.EMBOSS)} > 0 THEN hi ELSE (lo + hi) / 2 END, step + 1 FROM b WHERE step < 40)
SELECT p.doc_id, round(({_scale_sql(S.POLARITY)})::DOUBLE, 4) AS polarity, round(({_scale_sql(S.VOLUME)})::DOUBLE, 4) AS volume, round({_charge_sql("7.0", S.LEHNINGER)} + 1e-9, 6) AS net_charge,
  {_MEAN.format(_scale_sql(S.HYDROPATHY))} AS hydrophobicity, {_MEAN.format(_scale_sql(S.SOLUBILITY))} AS boman, {_MEAN.format("100 * (" + _scale_sql({"A": 1.0, "V": 2.9, "I": 3.9, "L": 3.9}) + ")")} AS aliphatic, round(i.pi + 1e-9, 6) AS isoelectric_point
FROM p JOIN (SELECT doc_id, (lo + hi) / 2 AS pi FROM b WHERE step = 40) i USING (doc_id)""",
)
def f17(spark, sf_dir):
    seq = F.col("seq")
    mean = {"hydrophobicity": S.per_letter(seq, S.HYDROPATHY), "boman": S.per_letter(seq, S.SOLUBILITY), "aliphatic": S.aliphatic_index(seq), "net_charge": S.net_charge(seq), "isoelectric_point": S.isoelectric_point(seq)}
    sums = {"polarity": S.scale_sum(seq, S.POLARITY), "volume": S.scale_sum(seq, S.VOLUME)}
    return parents(spark, sf_dir).select("doc_id", *[F.round(c, 4).alias(n) for n, c in sums.items()], *[F.round(c + 1e-9, 6).alias(n) for n, c in mean.items()])


@query("f18_amino_fractions", f"SELECT doc_id, length(seq) AS n, " + ", ".join(f"round((length(seq) - length(replace(seq, '{a}', ''))) / nullif(length(seq), 0)::DOUBLE, 9) AS f_{a.lower()}" for a in S.AMINO_ACIDS) + f" FROM {PARENTS}")
def f18(spark, sf_dir):
    p = parents(spark, sf_dir)
    return p.select("doc_id", F.length("seq").alias("n"), *[F.round(S.fraction_of(F.col("seq"), a), 9).alias(f"f_{a.lower()}") for a in S.AMINO_ACIDS])


@query(
    "f19_logit_sigmoid",
    "SELECT l_orderkey, l_linenumber, round(ln(q / (1 - q)), 9) AS lg, round(1 / (1 + exp(-greatest(-30, least(30, l_quantity - 25)))), 9) AS sg FROM (SELECT *, greatest(1e-6, least(l_discount, 1 - 1e-6)) AS q FROM lineitem)",
)
def f19(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(S.logit(F.col("l_discount")), 9).alias("lg"), F.round(S.sigmoid(F.col("l_quantity") - 25), 9).alias("sg"))


_CODON = lambda d, i: f"substr({d}, {i} * 3 - 2, 3)"


def _amino(d):
    return _AMINO.replace("dna", d)


@query(
    "f20_coding_changes",
    f"""SELECT doc_id, count(*) FILTER (c1 <> c2 AND a1 = a2) AS n_synonymous, count(*) FILTER (a1 <> a2) AS n_changes, coalesce(min(i) FILTER (a1 <> a2), 0)::BIGINT AS first_codon FROM (
SELECT doc_id, i, substr(dna, i * 3 - 2, 3) AS c1, substr(old, i * 3 - 2, 3) AS c2, {_amino('dna')} AS a1, {_amino('old')} AS a2 FROM (
SELECT *, unnest(generate_series(1, least(length(dna), length(old)) // 3)) AS i FROM (SELECT doc_id, translate(seq, '{LETTERS}', '{BASES}') AS dna, translate(wt, '{LETTERS}', '{BASES}') AS old FROM {PAIRS}))) GROUP BY doc_id""",
)
def f20(spark, sf_dir):
    p = pairs(spark, sf_dir).select("doc_id", *[S.codons(F.translate(c, LETTERS, BASES)).alias(c) for c in ("seq", "wt")])
    both = p.select("doc_id", F.posexplode(F.arrays_zip("seq", "wt")).alias("at", "c")).where("c.seq is not null and c.wt is not null")
    a, b = S.codon_amino(F.col("c.seq")), S.codon_amino(F.col("c.wt"))
    silent = (F.col("c.seq") != F.col("c.wt")) & (a == b)
    return both.groupBy("doc_id").agg(F.count_if(silent).alias("n_synonymous"), F.count_if(a != b).alias("n_changes"), F.coalesce(F.min(F.when(a != b, F.col("at") + 1)), F.lit(0)).cast("bigint").alias("first_codon"))


@query(
    "f22_mutation_position",
    "SELECT l_orderkey, l_linenumber, CASE WHEN a < s OR b > s + 8 THEN NULL WHEN b > a THEN (a - s + 1) || '-' || (b - s + 1) ELSE (a - s + 1)::VARCHAR END AS place FROM (SELECT l_orderkey, l_linenumber, l_suppkey % 20 + 1 AS s, l_quantity::BIGINT % 30 AS a, l_quantity::BIGINT % 30 + l_linenumber % 3 AS b FROM lineitem)",
)
def f22(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_suppkey % 20 + 1 as s", "cast(l_quantity as bigint) % 30 as a", "cast(l_quantity as bigint) % 30 + l_linenumber % 3 as b")
    return x.select("l_orderkey", "l_linenumber", S.place_in_window(F.col("a"), F.col("b"), F.col("s"), F.lit(9)).alias("place"))


@query(
    "f23_info_and_locus",
    "SELECT event_id, event_type AS kind, user_id::VARCHAR AS who, true AS flagged, 'chr' || user_id AS chrom, event_id AS start0, event_id + 100 AS end0 FROM events",
)
def f23(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    info = F.concat(F.lit("KIND="), "event_type", F.lit(";PASS;WHO="), "user_id", F.lit(";."))
    where = F.concat(F.lit("chr"), "user_id", F.lit(":"), "event_id", F.lit("-"), F.col("event_id") + 100)
    x = e.select("event_id", T.info_map(info).alias("m"), T.locus(where).alias("l"))
    return x.select("event_id", F.col("m")["KIND"].alias("kind"), F.col("m")["WHO"].alias("who"), F.map_contains_key("m", F.lit("PASS")).alias("flagged"), F.col("l.chrom").alias("chrom"), F.col("l.start").alias("start0"), F.col("l.end").alias("end0"))


@query(
    "f24_tolerant_casts",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN value WHEN 3 THEN user_id::DOUBLE END AS num, CASE WHEN event_id % 4 = 3 THEN user_id END AS whole, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag FROM events",
)
def f24(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.col("event_id") % 4
    raw = F.when(k == 0, F.concat(F.lit(" "), F.col("value").cast("string"))).when(k == 1, ".").when(k == 2, "n/a or so").otherwise(F.concat(F.col("user_id").cast("string"), F.lit(" ")))
    flag = F.when(F.col("event_id") % 3 == 0, " Yes").when(F.col("event_id") % 3 == 1, "F").otherwise("maybe")
    whole = F.when(k == 0, None).otherwise(raw)
    return e.select("event_id", T.tolerant_double(raw).alias("num"), T.tolerant_long(whole).alias("whole"), T.tolerant_bool(flag).alias("flag"))


@query("f25_list_text", "SELECT user_id, array_to_string(list_sort(list_distinct(list(event_type))), ';') AS kinds FROM events GROUP BY user_id")
def f25(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(T.list_text(F.collect_set("event_type")).alias("kinds"))


@query("f27_record_keys", "SELECT l_orderkey, l_linenumber, l_returnflag || '|' || l_partkey || '|' || '' || '|' || l_linestatus AS record_key FROM lineitem")
def f27(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return l.select("l_orderkey", "l_linenumber", T.keyed(F.col("l_returnflag"), F.col("l_partkey"), F.lit(None).cast("string"), F.col("l_linestatus")).alias("record_key"))


@query("f28_interval_padding", "SELECT l_orderkey, l_linenumber, greatest(0, l_suppkey - 5) AS start0, l_suppkey + l_quantity::BIGINT + 5 AS end0, split_part(l_suppkey || ',' || l_partkey, ',', 2)::BIGINT AS alt_reads FROM lineitem")
def f28(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    depth = F.concat_ws(",", "l_suppkey", "l_partkey")
    return l.select("l_orderkey", "l_linenumber", F.greatest(F.lit(0), F.col("l_suppkey") - 5).alias("start0"), (F.col("l_suppkey") + F.col("l_quantity").cast("bigint") + 5).alias("end0"), F.split_part(depth, F.lit(","), F.lit(2)).cast("bigint").alias("alt_reads"))


_IDS = f"list_transform(generate_series(1, length({{0}})), lambda i: instr('{S.AMINO_ACIDS}', substr({{0}}, i::BIGINT, 1))::DOUBLE)"


@query(
    "f29_token_encoding",
    f"""WITH t AS (SELECT p_partkey, list_concat([p_size::DOUBLE, p_retailprice], list_concat({_IDS.format('a')}, list_concat([0.0 FOR k IN range(12)], {_IDS.format('b')}))) AS ids FROM (SELECT *, upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) AS a, upper(regexp_replace(p_type, '[^A-Za-z]', '', 'g')) AS b FROM part))
SELECT p_partkey, len(ids) AS used, array_to_string(list_transform(list_resize(ids, (SELECT max(len(ids)) FROM t), 0.0), lambda x: round(x * 100)::BIGINT), ' ') AS ids FROM t""",
)
def f29(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    ids = S.encode_tokens(F.array(F.col("p_size").cast("double"), "p_retailprice"), S.letters_only(F.col("p_name")), S.letters_only(F.col("p_type")), S.AMINO_ACIDS)
    t = p.select("p_partkey", ids.alias("ids")).withColumn("used", F.size("ids").cast("bigint"))
    return S.to_length(t, "ids").select("p_partkey", "used", F.array_join(F.transform("ids", lambda x: F.round(x * 100).cast("bigint").cast("string")), " ").alias("ids"))


@query("f30_feature_ablation", "SELECT vec_id, round(list_sum(list_transform(generate_series(1, len(embedding)), lambda i: CASE WHEN i BETWEEN 5 AND 29 THEN 0.0 ELSE embedding[i]::DOUBLE * i END)), 5) AS weighted, len(embedding)::BIGINT AS n FROM embeddings")
def f30(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("x", S.ablated(F.col("embedding"), 4, 25))
    weighted = F.aggregate(F.transform("x", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return e.select("vec_id", F.round(weighted, 5).alias("weighted"), F.size("x").cast("bigint").alias("n"))


@query("p24_variant_kind", f"SELECT doc_id, CASE WHEN length(a) = 1 AND length(b) = 1 THEN 'SNV' WHEN length(a) = length(b) THEN 'MNV' ELSE 'INDEL_OR_COMPLEX' END AS kind FROM (SELECT doc_id, substr('ACGT', 1, (doc_id % 3 + 1)::BIGINT) AS a, substr('TGCA', 1, (n_chars % 3 + 1)::BIGINT) AS b FROM documents)")
def p24(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.expr("substr('ACGT', 1, cast(doc_id % 3 + 1 as int))").alias("a"), F.expr("substr('TGCA', 1, cast(n_chars % 3 + 1 as int))").alias("b"))
    return d.select("doc_id", S.variant_kind(F.col("a"), F.col("b")).alias("kind"))

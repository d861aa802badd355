"""Column expressions on headers, names, key-value texts and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for a missing value (fixed values).
MISSING = ("", ".", "NA", "N/A", "nan", "NaN", "None", "null")


def blank_to_null(value: Column, missing: tuple[str, ...] = MISSING) -> Column:
    v = F.trim(value)
    return F.when(v.isin(*missing), None).otherwise(v)


def tolerant_double(value: Column) -> Column:
    """A number, or null for blanks, markers of missing values and other text."""
    v = blank_to_null(value).try_cast("double")
    return F.when(F.isnan(v), None).otherwise(v)


def tolerant_long(value: Column) -> Column:
    return blank_to_null(value).try_cast("bigint")


def tolerant_bool(value: Column) -> Column:
    v = F.lower(blank_to_null(value))
    return F.when(v.isin("true", "t", "yes", "y", "1"), True).when(v.isin("false", "f", "no", "n", "0"), False)


def tag(header: Column, name: str, sep: str = "|") -> Column:
    """Value of NAME:value between separators, or null."""
    found = F.regexp_extract(header, rf"(?:^|[{sep}]){name}:([^{sep}]*)", 1)
    return F.when(found != "", found)


def tag_list(header: Column, name: str, sep: str = "|") -> Column:
    """Distinct sorted values of a comma list after NAME:, empty where there is none."""
    return distinct_sorted(F.split(F.coalesce(tag(header, name, sep), F.lit("")), ","))


def distinct_sorted(values: Column) -> Column:
    """Trimmed non-empty values, distinct and sorted."""
    trimmed = F.transform(values, lambda v: F.trim(v))
    return F.array_sort(F.array_distinct(F.filter(trimmed, lambda v: v.isNotNull() & (v != ""))))


def list_text(values: Column, sep: str = ";") -> Column:
    return F.array_join(distinct_sorted(values), sep)


def fragment_id(header: Column) -> Column:
    """Name of the sequenced fragment: first token, mate suffix (/1 /2 .1 .2) removed."""
    token = F.split(F.trim(header), r"[\s|]")[0]
    return F.regexp_replace(token, r"[/.][12]$", "")


def fragment_status(header: Column) -> Column:
    """How the mate was marked: slash, dot, comment (token 1:N:..) or none; empty if blank."""
    h = F.trim(F.coalesce(header, F.lit("")))
    token = F.split(h, r"[\s|]")[0]
    return F.when(h == "", "empty").when(token.rlike(r"/[12]$"), "slash").when(token.rlike(r"\.[12]$"), "dot").when(h.rlike(r"\s[12]:[YN]:"), "comment").otherwise("none")


def base_name(name: Column) -> Column:
    """Name without a protein suffix (.pN), copy suffix (-N) or version (.N)."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(name), r"\.p[0-9]+$", ""), r"-[0-9]+$", ""), r"\.[0-9]+$", "")


def content_id(prefix: str, length: int, *parts: Column) -> Column:
    """Stable id from the SHA-256 of the parts."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length))


def group_id(taxa: Column) -> Column:
    """Source-group id of a set of taxa: 20 hexadecimal digits."""
    return F.substring(F.sha2(F.array_join(distinct_sorted(taxa), ";"), 256), 1, 20)


def hla_two_field(name: Column) -> Column:
    """GENE*FF:FF of an allele name: prefix HLA- removed, the last chain of a pair kept."""
    chain = F.regexp_extract(F.upper(F.trim(name)), r"([^/]*)$", 1)
    bare = F.regexp_replace(chain, r"^HLA-", "")
    found = F.regexp_extract(bare, r"^([A-Z0-9]+\*[0-9]+:[0-9]+)", 1)
    return F.when(found != "", found).otherwise(bare)


def support_key(name: Column) -> Column:
    """Letters and digits of an allele's name in upper case, without HLA- or HLA_."""
    return F.regexp_replace(F.regexp_replace(F.upper(name), "HLA[-_]", ""), "[^A-Z0-9]", "")


def compact_hla(name: Column) -> Column:
    """HLA-A0201 or DRB1_0101 spellings as GENE*FF:FF."""
    bare = F.regexp_replace(F.upper(F.trim(name)), r"^HLA-", "")
    return F.regexp_replace(bare, r"^([A-Z]+[0-9]?)[*_]?([0-9]{2}):?([0-9]{2}).*$", r"$1*$2:$3")


def info_map(info: Column) -> Column:
    """KEY=value;FLAG text as a map; a flag maps to the empty text."""
    pairs = F.filter(F.split(F.coalesce(info, F.lit("")), ";"), lambda p: (p != "") & (p != "."))
    keys = F.transform(pairs, lambda p: F.split(p, "=", 2)[0])
    values = F.transform(pairs, lambda p: F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit("")))
    return F.map_from_arrays(keys, values)


def gtf_attribute(attributes: Column, key: str) -> Column:
    found = F.regexp_extract(attributes, key + ' "([^"]+)"', 1)
    return F.when(found != "", found)


def locus(text: Column) -> Column:
    """struct<chrom, start, end> of chrom:start-end; null where the text differs."""
    p = r"^([^:]+):([0-9]+)-([0-9]+)$"
    s = F.struct(F.regexp_extract(text, p, 1).alias("chrom"), F.regexp_extract(text, p, 2).try_cast("bigint").alias("start"), F.regexp_extract(text, p, 3).try_cast("bigint").alias("end"))
    return F.when(text.rlike(p), s)


def keyed(*parts: Column) -> Column:
    """Record key: parts joined by |, null as empty."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def six_digits(value: Column) -> Column:
    """A number with six significant digits and no trailing zeros, ties away from 0; an
    exponent below 1e-4 and from 1e6 on; null stays null."""
    x = value.cast("double")
    # d.ddddde+dd, written once: Spark shares an expression that occurs outside of branches, so
    # what follows has none. Null, nan and infinities have no exponent, so they give null.
    written = F.format_string("%.5e", F.abs(x))
    exponent = written.substr(F.lit(9), F.lit(4)).try_cast("int")
    plain = (F.abs(2 * exponent - 1) <= 9).cast("int")
    shift = exponent * plain
    digits = F.concat(F.repeat(F.lit("0"), -shift), written.substr(F.lit(1), F.lit(1)), written.substr(F.lit(3), F.lit(5)))
    point = F.greatest(shift, F.lit(0)) + 1
    fixed = F.concat(digits.substr(F.lit(1), point), F.lit("."), digits.substr(point + 1, F.lit(12)))
    number = F.concat(F.repeat(F.lit("-"), (x < 0).cast("int")), F.rtrim(F.rtrim(fixed, F.lit("0")), F.lit(".")), written.substr(F.lit(8), 5 * (1 - plain)))
    return F.coalesce(number, F.when(F.isnan(x), "nan").when(x > 0, "inf").when(x < 0, "-inf"))

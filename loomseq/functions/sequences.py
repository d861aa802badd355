"""Column expressions on sequences, windows and codons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomseq.functions.mutants import INVALID, mutation_counts, mutation_facts, mutation_windows  # noqa: F401

#: The twenty amino acids (fixed values).
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"
#: The standard genetic code in TCAG order (fixed values).
CODON_BASES = "TCAG"
CODON_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Hydropathy of the amino acids after Kyte and Doolittle (fixed values).
HYDROPATHY = {"A": 1.8, "C": 2.5, "D": -3.5, "E": -3.5, "F": 2.8, "G": -0.4, "H": -3.2, "I": 4.5, "K": -3.9, "L": 3.8, "M": 1.9, "N": -3.5, "P": -1.6, "Q": -3.5, "R": -4.5, "S": -0.8, "T": -0.7, "V": 4.2, "W": -0.9, "Y": -1.3}

#: Side-chain volumes in cubic angstrom, and polarity classes (fixed values).
VOLUME = {"A": 88.6, "C": 118.8, "D": 111.1, "E": 138.3, "F": 189.9, "G": 60.1, "H": 153.2, "I": 166.6, "K": 168.6, "L": 166.6, "M": 162.9, "N": 114.1, "P": 115.0, "Q": 146.2, "R": 174.0, "S": 105.9, "T": 119.0, "V": 140.0, "W": 227.8, "Y": 193.6}
POLARITY = {**dict.fromkeys("ADENQRSTY", 1.0), **dict.fromkeys("ILMFPVW", -1.0)}
#: Free energies of transfer after Radzicka and Wolfenden, as in the Boman index (fixed values).
SOLUBILITY = {"A": -1.81, "C": -1.28, "D": 8.72, "E": 6.81, "F": -2.98, "G": -0.94, "H": 4.66, "I": -4.92, "K": 5.55, "L": -4.92, "M": -2.35, "N": 6.64, "P": 0.0, "Q": 5.54, "R": 14.92, "S": 3.4, "T": 2.57, "V": -4.04, "W": -2.33, "Y": 0.14}
#: Dissociation constants: positive and negative groups, after Lehninger and of EMBOSS; n and
#: c are the ends of the chain (fixed values).
LEHNINGER = ({"n": 9.69, "K": 10.5, "R": 12.4, "H": 6.0}, {"c": 2.34, "D": 3.86, "E": 4.25, "C": 8.33, "Y": 10.0})
EMBOSS = ({"n": 8.6, "K": 10.8, "R": 12.5, "H": 6.5}, {"c": 3.6, "D": 3.9, "E": 4.1, "C": 8.5, "Y": 10.1})


def let(value: Column, use) -> Column:
    """use(value) with value computed once: inside a lambda an expression would otherwise
    be computed again for every element."""
    return F.transform(F.array(value), use)[0]


def each_of(df: DataFrame, array: Column, out: str) -> DataFrame:
    """df with a row for each element of an array without nulls, as explode. From a plain
    explode Spark infers a filter on the array's size and moves it down, so the array and
    what it is made from would be computed several times."""
    return df.withColumn(out, F.explode_outer(array)).where(F.col(out).isNotNull())


def letters_only(text: Column) -> Column:
    """ASCII letters of a text in upper case; other characters go first, so that upper
    case never changes the length."""
    return F.upper(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z]", ""))


def normal_sequence(text: Column) -> Column:
    """Trimmed, upper case, one terminal stop mark dropped."""
    return F.regexp_replace(F.upper(F.trim(F.coalesce(text, F.lit("")))), r"\*$", "")


def ascii_part(sequence: Column, start: Column, length: Column) -> Column:
    """Part of an ASCII text, by byte position: unlike substring on text, the cost does
    not grow with start."""
    return F.substring(sequence.cast("binary"), start, length).cast("string")


CHUNK = 4096


def window_chunks(df: DataFrame, sequence: str, lengths: list[int], length: str = "pep_len", chunk: int = CHUNK) -> DataFrame:
    """The windows of each length as arrays (__windows, binary), for parts of a sequence that
    start at __offset; __chunks is the number of parts. Sequences are ASCII (see letters_only);
    those shorter than a length give none of that length. Long sequences are cut into parts
    that overlap, so the windows of a row are never all held at once."""
    most = max(lengths)
    others = [c for c in df.columns if c != sequence]
    raw = F.col(sequence).cast("binary")
    count = F.greatest(F.ceil(F.octet_length(raw) / chunk).cast("int"), F.lit(1))
    offsets = F.explode(F.sequence(F.lit(0), (count - 1) * chunk, F.lit(chunk)))
    chunks = df.select(*others, count.alias("__chunks"), offsets.alias("__offset"), raw.alias("__raw"))
    chunks = chunks.select(*others, "__chunks", "__offset", F.substring("__raw", F.col("__offset") + 1, F.lit(chunk + most - 1)).alias("__part"))
    sized = chunks.select(*others, "__chunks", "__offset", "__part", F.explode(F.array(*[F.lit(k) for k in lengths])).alias(length))
    sized = sized.where(F.octet_length("__part") >= F.col(length))
    n = F.least(F.lit(chunk), F.octet_length("__part") - F.col(length) + 1)
    part, k = F.col("__part"), F.col(length)
    return sized.select(*others, length, "__chunks", "__offset", F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(part, i, k)).alias("__windows"))


def windows(df: DataFrame, sequence: str, lengths: list[int], start: str = "pep_start", length: str = "pep_len", out: str = "peptide") -> DataFrame:
    """One row for each window of each length, with its 1-based start; the sequence column
    is not repeated."""
    others = [c for c in df.columns if c != sequence]
    placed = window_chunks(df, sequence, lengths, length).select(*others, length, "__offset", F.posexplode("__windows").alias("__at", "__raw"))
    return placed.select(*others, length, (F.col("__offset") + F.col("__at") + 1).alias(start), F.col("__raw").cast("string").alias(out))


#: Letters of a part in which windows are made distinct; most sequences are one part.
DISTINCT_CHUNK = 1 << 15


def distinct_windows(df: DataFrame, sequence: str, k: int, key: str, out: str = "peptide") -> DataFrame:
    """The distinct windows of each row of df, whose key is unique. Those of a sequence of
    one part are made distinct where they are; those of longer ones are placed by key."""
    others = [c for c in df.columns if c != sequence]
    one = F.octet_length(sequence) <= DISTINCT_CHUNK

    def found(rows: DataFrame) -> DataFrame:
        parts = window_chunks(rows, sequence, [k], "__len", DISTINCT_CHUNK)
        # As texts: array_distinct hashes them, while it compares binary values pair by pair.
        text = F.transform("__windows", lambda w: w.cast("string"))
        return parts.select(*others, F.explode(F.array_distinct(text)).alias(out))

    return found(df.where(one)).unionAll(found(df.where(~one).repartition(key)).dropDuplicates([key, out]))


def window_summary(df: DataFrame, sequence: str, lengths: list[int], key: str) -> DataFrame:
    """key, pep_len, n_windows, n_distinct, first_pep, last_pep of each row of df, whose key is
    unique. Parts are summed up where they are; windows meet, as 64-bit hashes, only for
    sequences of several parts."""
    parts = window_chunks(df.select(key, sequence), sequence, lengths, "pep_len", DISTINCT_CHUNK)
    w = F.col("__windows")
    hashes = F.array_distinct(F.transform(w, lambda x: F.xxhash64(x)))
    sums = parts.select(key, "pep_len", "__chunks", F.size(w).cast("bigint").alias("n"), F.array_min(w).alias("lo"), F.array_max(w).alias("hi"), hashes.alias("h"))
    single = F.sum(F.when(F.col("__chunks") == 1, F.size("h")))
    facts = sums.groupBy(key, "pep_len").agg(F.sum("n").alias("n_windows"), single.cast("bigint").alias("single"), F.min("lo").cast("string").alias("first_pep"), F.max("hi").cast("string").alias("last_pep"))
    spread = sums.where("__chunks > 1").select(key, "pep_len", F.explode("h").alias("h")).distinct()
    several = spread.groupBy(key, "pep_len").agg(F.count("*").alias("several"))
    both = facts.join(several, [key, "pep_len"], "left")
    return both.select(key, "pep_len", "n_windows", F.coalesce("single", "several").alias("n_distinct"), "first_pep", "last_pep")


def window_total(sequence: Column, lengths: list[int]) -> Column:
    """Number of windows without making them."""
    total = F.lit(0).cast("bigint")
    for k in lengths:
        total = total + F.greatest(F.length(sequence) - k + 1, F.lit(0))
    return total


def reverse_complement(dna: Column) -> Column:
    return F.translate(F.reverse(F.upper(dna)), "ACGT", "TGCA")


def codon_amino(codon: Column) -> Column:
    """Amino acid of a codon, X where a base is unknown; computed from the bases' places."""
    place = [F.instr(F.lit(CODON_BASES), codon.substr(F.lit(k), F.lit(1))) for k in (1, 2, 3)]
    known = (F.length(codon) == 3) & (place[0] > 0) & (place[1] > 0) & (place[2] > 0)
    return F.when(known, F.lit(CODON_AMINO).substr((place[0] - 1) * 16 + (place[1] - 1) * 4 + place[2], F.lit(1))).otherwise("X")


def codons(dna: Column) -> Column:
    """Whole codons of an ASCII sequence, in order."""

    def cut(d: Column) -> Column:
        n = F.floor(F.octet_length(d) / 3).cast("int")
        starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(d, i * 3 - 2, F.lit(3)).cast("string"))

    return let(dna.cast("binary"), cut)


def translate_codons(dna: Column) -> Column:
    """Amino acids of whole codons, X where a codon is unknown, one last stop dropped."""
    letters = F.transform(codons(F.upper(dna)), codon_amino)
    return F.regexp_replace(F.array_join(letters, ""), r"\*$", "")


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common beginning of two texts: binary search on equal prefixes, so
    the cost is the logarithm of the length times a comparison."""
    def find(both: Column) -> Column:
        a, b = both["a"], both["b"]

        def step(acc: Column, _: Column) -> Column:
            mid = F.floor((acc["lo"] + acc["hi"] + 1) / 2).cast("int")
            same = F.substring(a, F.lit(1), mid) == F.substring(b, F.lit(1), mid)
            return F.when(acc["lo"] >= acc["hi"], acc).otherwise(F.struct(F.when(same, mid).otherwise(acc["lo"]).alias("lo"), F.when(same, acc["hi"]).otherwise(mid - 1).alias("hi")))

        start = F.struct(F.lit(0).alias("lo"), F.least(F.length(a), F.length(b)).alias("hi"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(32)), start, step)["lo"]

    return let(F.struct(a.alias("a"), b.alias("b")), find)


def changed_region(wild: Column, mutant: Column, frameshift: Column) -> Column:
    """struct<prefix, suffix, wt_end, mt_end>: the part of each sequence that differs, as
    common prefix and suffix lengths; a frameshift keeps its whole tail."""
    prefix = common_prefix(wild, mutant)
    most = F.least(F.length(wild), F.length(mutant)) - prefix
    suffix = F.when(frameshift, 0).otherwise(F.least(common_prefix(F.reverse(wild), F.reverse(mutant)), most))
    return F.struct(prefix.alias("prefix"), suffix.alias("suffix"), (F.length(wild) - suffix).alias("wt_end"), (F.length(mutant) - suffix).alias("mt_end"))


def count_below(values: Column, x: Column, equal: bool = False) -> Column:
    """Number of elements of an ascending array below x (or equal to it), by binary search."""

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        v = F.get(values, mid)
        more = (acc["lo"] < acc["hi"]) & ((v <= x) if equal else (v < x))
        return F.struct(F.when(more, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(~more & (acc["lo"] < acc["hi"]), mid).otherwise(acc["hi"]).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(32)), F.struct(F.lit(0).alias("lo"), F.size(values).alias("hi")), step)["lo"]


def invalid_places(sequence: Column) -> Column:
    """0-based places of INVALID letters of an ASCII sequence, ascending: lengths of the
    stretches between them, summed up."""
    stretches = F.split(sequence, "[*X?U]")
    lengths = F.transform(stretches, F.length)
    ends = F.aggregate(lengths, F.array().cast("array<int>"), lambda a, n: F.concat(a, F.array(F.coalesce(F.element_at(a, F.when(F.size(a) > 0, -1)), F.lit(-1)) + 1 + n)))
    # The last stretch ends with the sequence.
    return let(ends, lambda e: F.slice(e, F.lit(1), F.size(e) - 1))


def anchor_of(first: Column, last: Column, start: Column, end: Column, frameshift: Column, whole_event: bool = False) -> Column:
    """0-based place that a context is centred on: the middle of the changed residues
    first..last (half-open), their junction where there are none; for a frameshift the middle
    of the window start..end, or the breakpoint for a context of the whole event."""
    middle = lambda a, b: F.floor((a + b - 1) / 2).cast("int")
    shifted = first if whole_event else middle(start, end)
    return F.when(frameshift, shifted).when(last > first, middle(first, last)).otherwise(first)


def event_context(sequence: Column, first: Column, last: Column, frameshift: Column, width: int) -> Column:
    """struct<start, end> (0-based, half-open) of a stretch of width residues centred on the
    change, or on a frameshift's breakpoint, moved inwards at the edges; all of a shorter
    sequence, or where width is 0."""
    n = F.length(sequence)
    centre = anchor_of(first, last, first, last, frameshift, whole_event=True)
    begin = F.greatest(F.lit(0), F.least(centre - width // 2, n - width))
    whole = (n <= width) if width > 0 else F.lit(True)
    return F.struct(F.when(whole, 0).otherwise(begin).alias("start"), F.when(whole, n).otherwise(begin + width).alias("end"))


def bounded_extension(invalid: Column, n: Column, start: Column, end: Column, anchor: Column, width: int) -> Column:
    """struct<start, end> of a window start..end (0-based, half-open) extended to width
    residues around anchor: it holds the whole window and stays between the nearest invalid
    residues to its left and right, which are found by binary search in their sorted places;
    all there is where that is too little."""
    k = count_below(invalid, start)
    low = F.coalesce(F.get(invalid, k - 1) + 1, F.lit(0))
    high = F.coalesce(F.get(invalid, count_below(invalid, end)), n)

    def place(b: Column) -> Column:
        target = F.least(F.greatest(F.lit(width), end - start), b["high"] - b["low"])
        begin = F.least(F.greatest(anchor - F.floor(target / 2).cast("int"), b["low"], end - target), start, b["high"] - target)
        return F.struct(begin.alias("start"), (begin + target).alias("end"))

    return let(F.struct(low.alias("low"), high.alias("high")), place)


def covered_counts(df: DataFrame, key: str, mutant: str, wild: str, k: int, chunk: int = 2048) -> DataFrame:
    """key, n_windows (windows of k letters of the mutant sequence that cover its change, see
    covers_change) and n_same (those that equal the wild type's at the same place) of each row
    that has such windows. df also holds prefix and mt_end. Both sequences' windows are compared
    where the row is, in chunks; only counts are shuffled."""
    m, w = F.col(mutant).cast("binary"), F.col(wild).cast("binary")
    first, last = F.col("prefix"), F.col("mt_end")
    low = F.greatest(F.lit(0), first - k + 1).cast("int")
    high = F.least(F.when(last > first, last - 1).otherwise(first - 1), F.octet_length(m) - k).cast("int")
    spans = each_of(df.select(key, m.alias("m"), w.alias("w"), low.alias("low"), high.alias("high")), F.when(F.col("high") >= F.col("low"), F.expr(f"sequence(low, high, {chunk})")), "at")
    part = lambda c: F.substring(c, F.col("at") + 1, F.lit(chunk + k - 1)).alias(c)
    cut = spans.select(key, (F.least(F.col("high"), F.col("at") + chunk - 1) - F.col("at") + 1).alias("n"), part("m"), part("w"))
    same = F.size(F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: F.substring("m", i, F.lit(k)) == F.substring("w", i, F.lit(k))))
    return cut.select(key, "n", same.alias("same")).groupBy(key).agg(F.sum("n").alias("n_windows"), F.sum("same").alias("n_same"))


def covers_change(start: Column, length: Column, prefix: Column, mt_end: Column) -> Column:
    """Whether a window (1-based start) covers changed residues; for an empty change, the
    junction between the residues beside it."""
    last = start + length - 1
    return F.when(mt_end > prefix, (start <= mt_end) & (last > prefix)).otherwise((start <= prefix) & (last > prefix))


def centred_context(sequence: Column, part: Column, width: int = 27) -> Column:
    """A stretch of width characters centred on the first occurrence of part, moved inwards
    at the edges; null where part does not occur."""
    at = F.instr(sequence, part)
    left = at - F.floor((F.lit(width) - F.length(part)) / 2).cast("int")
    start = F.greatest(F.lit(1), F.least(left, F.length(sequence) - width + 1))
    return F.when(at > 0, sequence.substr(start, F.lit(width)))


def fraction_of(sequence: Column, letter: str) -> Column:
    n = F.length(sequence)
    return F.when(n > 0, (n - F.length(F.replace(sequence, F.lit(letter), F.lit("")))) / n)


def scale_sum(sequence: Column, scale: dict[str, float]) -> Column:
    """Sum of a per-letter scale, by counting each letter."""
    total = F.lit(0.0)
    for letter, value in scale.items():
        total = total + (F.length(sequence) - F.length(F.replace(sequence, F.lit(letter), F.lit("")))) * F.lit(value)
    return total


def letter_counts(sequence: Column, letters: str) -> Column:
    """struct of the number of each letter."""
    n = F.length(sequence)
    return F.struct(*[(n - F.length(F.replace(sequence, F.lit(c), F.lit("")))).alias(c) for c in letters])


def charge_at(counts: Column, ph: Column, constants: tuple[dict, dict] = LEHNINGER) -> Column:
    """Net charge of a chain with these letter_counts of KRHDECY."""
    total = F.lit(0.0)
    for sign, group in zip((1, -1), constants, strict=True):
        for c, pk in group.items():
            number = F.lit(1) if c in "nc" else counts[c]
            total = total + sign * number / (1 + F.pow(F.lit(10.0), sign * (ph - pk)))
    return total


def net_charge(sequence: Column, ph: float = 7.0) -> Column:
    return let(letter_counts(sequence, "KRHDECY"), lambda counts: charge_at(counts, F.lit(ph)))


def isoelectric_point(sequence: Column, steps: int = 40) -> Column:
    """The pH at which the net charge is 0, by halving the range from 0 to 14."""

    def find(counts: Column) -> Column:
        def step(acc: Column, _: Column) -> Column:
            mid = (acc["lo"] + acc["hi"]) / 2
            up = charge_at(counts, mid, EMBOSS) > 0
            return F.struct(F.when(up, mid).otherwise(acc["lo"]).alias("lo"), F.when(up, acc["hi"]).otherwise(mid).alias("hi"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct(F.lit(0.0).alias("lo"), F.lit(14.0).alias("hi")), step, lambda acc: (acc["lo"] + acc["hi"]) / 2)

    return let(letter_counts(sequence, "KRHDECY"), find)


def per_letter(sequence: Column, scale: dict[str, float]) -> Column:
    """Mean of a scale over the letters; null for an empty sequence."""
    return F.when(F.length(sequence) > 0, scale_sum(sequence, scale) / F.length(sequence))


def aliphatic_index(sequence: Column) -> Column:
    return 100 * per_letter(sequence, {"A": 1.0, "V": 2.9, "I": 3.9, "L": 3.9})


def logit(p: Column, eps: float = 1e-6) -> Column:
    q = F.greatest(F.lit(eps), F.least(p, F.lit(1 - eps)))
    return F.ln(q / (1 - q))


def sigmoid(x: Column, most: float = 30.0) -> Column:
    z = F.greatest(F.lit(-most), F.least(x, F.lit(most)))
    return 1 / (1 + F.exp(-z))


def letter_ids(sequence: Column, vocabulary: str) -> Column:
    """Ids of the letters of an ASCII sequence: 1-based place in vocabulary, 0 for others."""

    def cut(raw: Column) -> Column:
        n = F.octet_length(raw)
        places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.instr(F.lit(vocabulary), F.substring(raw, i, F.lit(1)).cast("string")))

    return let(sequence.cast("binary"), cut)


def encode_tokens(features: Column, peptide: Column, other: Column, vocabulary: str, gap: int = 12) -> Column:
    """features, ids of the peptide, gap zeros, ids of the other sequence, in one array."""
    zeros = F.array_repeat(F.lit(0.0), gap)
    ids = lambda s: F.transform(letter_ids(s, vocabulary), lambda x: x.cast("double"))
    return F.concat(features.cast("array<double>"), ids(peptide), zeros, ids(other))


def to_length(df: DataFrame, column: str, length: int | None = None) -> DataFrame:
    """Arrays cut, or filled with zeros, to a length; to the largest in df if none is given."""
    most = df.agg(F.max(F.size(column)).alias("__most")) if length is None else df.sparkSession.range(1).select(F.lit(length).alias("__most"))
    fill = F.array_repeat(F.lit(0.0), F.greatest(F.col("__most") - F.size(column), F.lit(0)))
    return df.crossJoin(F.broadcast(most)).withColumn(column, F.slice(F.concat(column, fill), F.lit(1), F.col("__most"))).drop("__most")


def variant_kind(ref: Column, alt: Column) -> Column:
    """SNV, MNV or INDEL_OR_COMPLEX."""
    return F.when((F.length(ref) == 1) & (F.length(alt) == 1), "SNV").when(F.length(ref) == F.length(alt), "MNV").otherwise("INDEL_OR_COMPLEX")


def fragment_of_variant(wild: Column, kind: Column, position: Column, inserted: Column, removed: Column) -> Column:
    """Mutant protein from a wild one: missense replaces and FS replaces the tail from
    position (1-based), ins puts text before it, del takes removed residues away."""
    head = F.substring(wild, F.lit(1), position - 1)
    tail = lambda skip: wild.substr(position + skip, F.length(wild))
    return F.when(kind == "missense", F.concat(head, inserted, tail(F.length(inserted)))).when(kind == "ins", F.concat(head, inserted, tail(F.lit(0)))).when(kind == "del", F.concat(head, tail(removed))).when(kind == "FS", F.concat(head, inserted))


def place_in_window(first: Column, last: Column, start: Column, length: Column) -> Column:
    """Where changed residues first..last lie in a window: one number, or a-b for more than
    one; null where the window does not hold them all. All places are 1-based."""
    a, b = first - start + 1, last - start + 1
    inside = (a >= 1) & (b <= length)
    return F.when(inside & (last > first), F.concat_ws("-", a, b)).when(inside, a.cast("string"))


def ablated(features: Column, start: int, count: int) -> Column:
    """The feature vector with count values from place start (0-based) set to zero."""
    return F.transform(features, lambda x, i: F.when((i >= start) & (i < start + count), F.lit(0.0)).otherwise(x))

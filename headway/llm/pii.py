"""Personal data by fixed rules and bootstrapped contextual extraction, with DataFrame functions only.

Base spans: e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers, leftmost and not
overlapping per kind.  A text is split at the matches of a kind; running sums of the lengths of pieces
and matches are the positions.

Bootstrapping: identifier-like strings (runs of words that hold a digit or ``@``) are *instances*; a
lexical *pattern* is the word before with the shape of the instance (digits 9, letters a, runs counted
in classes), or the word before alone.  Instances that hold a valid base span are the seeds of their
kind; those that only look like one and fail its check (Luhn, byte range, digits) are counter-examples.
Pattern and instance scores are then refined in turn over the bipartite graph with grouped sums: a
pattern's score is the mean score of its distinct instances, shrunk towards zero for small support;
an unseeded instance takes, for each pattern, the mean score of its *other* patterns, so that no
pattern confirms itself.  After ``ROUNDS`` rounds, unseeded instances that a pattern of at least
``MIN_SEEDS`` distinct seeds and a score of ``MIN_SCORE`` proposes become spans of the pattern's kind.

The regular expressions are the contract's, written with possessive quantifiers and a guard that
begins only at the start of a run (or at the end of the last match): same matches, linear time.  Instances and
the word before them are found the same way: only the start of a word is tried, whatever its length.

Defined cases: null text is empty (no spans); repeated rows get the same spans; very long texts keep
all their spans; an empty table gives an empty result; other columns are ignored (``mask`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import prepare, rows_of, stored, unpack

# fixed values: the four kinds in listed order
_LOCAL = "A-Za-z0-9._%+-"
KINDS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_IP_PART = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
_WORD = r"[^\x20\x09-\x0D]"
CANDIDATE = rf"(?<!{_WORD})[^\x20\x09-\x0D0-9@]*+[0-9@]{_WORD}*+(?:\x20[(+]?[0-9]{_WORD}*+)*+"
LAST_WORD = rf"(?<!{_WORD})({_WORD}++)[\x20\x09-\x0D]++\z"
_SEARCHES = [*((k, KINDS[k], GUARDS[k]) for k in KINDS), ("c", CANDIDATE, "[0-9@]")]   # name, pattern, guard
ROUNDS = 3
MIN_SEEDS = 5
MIN_SCORE = 0.9


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda acc, i: acc + _luhn_digit(F.substring(digits, i, F.lit(1)).cast("int"), (n - i) % 2 == 1))
    return total % 10 == 0


def _luhn_digit(d: Column, double: Column) -> Column:
    twice = d * 2
    return F.when(double, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$")
    digits = _digits(m)
    n = F.length(digits)
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(digits)).otherwise(False)
    return n.between(9, 15)


def _split(df: DataFrame, text: str, name: str, regex: str, guard: str) -> DataFrame:
    """``<name>_m`` matches and ``<name>_p`` the pieces between them; both null if the guard fails."""
    t = F.col(text)
    return (df.withColumn(f"{name}_m", F.when(t.rlike(guard), F.regexp_extract_all(t, F.lit(regex), F.lit(0))))
            .withColumn(f"{name}_p", F.when(F.size(f"{name}_m") > 0, F.split(t, regex, -1))))


def _before(piece: Column) -> Column:
    """The last word of the piece before an instance, in lower case."""
    return F.lower(F.regexp_extract(piece, LAST_WORD, 1))


def matches(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """One row per match of a kind, and per instance (kind ``c``), of each distinct (key): hit, start in
    code points and, for instances, the word before.  Stored: every text is split once.

    Starts are running sums of the lengths of pieces and matches, over the matches of one text."""
    for name, regex, guard in _SEARCHES:
        df = _split(df, text, name, regex, guard)
    none = F.array().cast("array<string>")
    lists = F.array(*[F.struct(
        F.lit(name).alias("kind"), F.col(f"{name}_m").alias("hits"),
        F.transform(f"{name}_p", lambda x: F.length(x)).alias("gaps"),
        (F.transform(f"{name}_p", _before) if name == "c" else none).alias("lefts")) for name, _, _ in _SEARCHES])
    found = stored(df.select(*key, F.explode(F.filter(lists, lambda x: F.size(x["hits"]) > 0)).alias("x")), "pii-found")
    one = found.dropDuplicates([*key, "x"])                        # repeated rows are looked at once
    rows = one.select(*key, F.col("x.kind").alias("kind"),
                      F.posexplode(F.arrays_zip("x.hits", "x.gaps", "x.lefts")).alias("k", "y"))
    rows = rows.where("y.hits is not null").select(
        *key, "kind", "k", F.col("y.hits").alias("hit"), F.col("y.gaps").alias("gap"), F.col("y.lefts").alias("left"))
    upto = Window.partitionBy(*key, "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("hit")).over(upto)
    return rows.withColumn("start", (end - F.length("hit")).cast("int"))


def _spans(rows: DataFrame, key: list[str], **named: Column) -> DataFrame:
    """Rows (key, start, end, kind) -> arrays of distinct (start, number, end, kind) per key, in the contract's order:
    for each name those of the rows that meet its condition."""
    no = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    span = F.struct("start", no.alias("no"), "end", "kind")
    return rows.groupBy(*key).agg(*[F.array_sort(F.collect_set(F.when(c, span))).alias(n) for n, c in named.items()])


def _base_rows(found: DataFrame, key: list[str]) -> DataFrame:
    """One row per valid base span: key, start, end, kind."""
    rows = found.where("kind != 'c'")
    ok = F.coalesce(*[F.when(F.col("kind") == k, _valid(k, F.col("hit"))) for k in KINDS])
    return rows.where(ok).select(*key, "start", (F.col("start") + F.length("hit")).cast("int").alias("end"), "kind")


def base_spans(found: DataFrame, key: list[str]) -> DataFrame:
    """``base`` spans of every key that has any."""
    return _spans(_base_rows(found, key), key, base=F.lit(True))


def _cuts(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows (key, start, end, kind) -> ``cuts`` of every key: its spans without overlaps.  Spans that overlap are
    one, of the kind of the longest (ties: the first in the contract's order)."""
    no = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    by = Window.partitionBy(*key).orderBy("start", "no", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("no", no).withColumn("new", F.when(F.col("start") < reach, 0).otherwise(1))
    rows = rows.withColumn("nth", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    best = F.min(F.struct((F.col("start") - F.col("end")).alias("size"), "start", "no", "kind"))
    one = rows.groupBy(*key, "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"), best.alias("best"))
    return _spans(one.select(*key, "start", "end", F.col("best.kind").alias("kind")), key, cuts=F.lit(True))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


# ---------------------------------------------------------------- bootstrapping

def instances(found: DataFrame, key: list[str]) -> DataFrame:
    """One row per identifier-like string: key, start, end, hit, left (the word before, lower case)."""
    rows = found.where("kind = 'c'").withColumnRenamed("hit", "raw").withColumnRenamed("start", "at")
    # quotes and closing punctuation are not part of an identifier
    opened = F.regexp_replace("raw", r"^[^A-Za-z0-9+(]++", "")
    bare = F.regexp_replace(opened, r"(?<![^A-Za-z0-9)])[^A-Za-z0-9)]++$", "")
    return (rows.withColumn("hit", bare)
            .withColumn("start", (F.col("at") + F.length("raw") - F.length(opened)).cast("int")).where("length(hit) >= 4")
            .select(*key, "start", (F.col("start") + F.length("hit")).cast("int").alias("end"), "hit", "left"))


def _shape(c: Column) -> Column:
    """Digits 9, letters a; runs up to four keep their length, longer ones count as 5-8, 9-16 and more."""
    s = F.regexp_replace(F.regexp_replace(c, "[0-9]", "9"), r"\p{L}", "a")
    for mark in "9a":
        s = F.regexp_replace(s, f"{mark}{{17,}}", f"{mark}+++")
        s = F.regexp_replace(s, f"{mark}{{9,16}}", f"{mark}++")
        s = F.regexp_replace(s, f"{mark}{{5,8}}", f"{mark}+")
    return s


def seed_kind(hit: Column) -> Column:
    """The first kind with a valid base match inside an instance; "none" if it only looks like one of a
    kind and fails its check; else null."""
    looks = [hit.rlike(GUARDS[k]) & hit.rlike(KINDS[k]) for k in KINDS]
    return F.coalesce(*[F.when(x & _holds(k, hit), F.lit(k)) for k, x in zip(KINDS, looks)],
                      *[F.when(x, F.lit("none")) for x in looks])


def _holds(kind: str, hit: Column) -> Column:
    return F.exists(F.regexp_extract_all(hit, F.lit(KINDS[kind]), F.lit(0)), lambda m: _valid(kind, m))


def discovered(found: DataFrame, key: list[str], rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
               min_score: float = MIN_SCORE) -> DataFrame:
    """``found`` (instances, stored) -> key, start, end, kind of the unseeded instances that
    high-confidence patterns propose."""
    text = found.groupBy("hit", "left").count().select("hit", "left")          # the graph's distinct edges
    named = text.select("hit", "left").withColumn("kind", seed_kind(F.col("hit"))) \
                .withColumn("shape", _shape(F.col("hit")))
    edges = stored(named.select(
        "hit", "kind", F.explode(F.array(F.concat_ws(" ", "left", "shape"), F.concat_ws(" ", "left", F.lit("*"))))
        .alias("pattern")).distinct(), "pii-edges")
    # a pattern belongs to the kind that most of its seeds have
    votes = edges.where("kind != 'none'").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    owner = votes.groupBy("pattern").agg(F.max(F.struct("seeds", "kind")).alias("o")) \
                 .select("pattern", F.col("o.kind").alias("own"), F.col("o.seeds").alias("seeds"))
    owner = owner.where(F.col("seeds") >= min_seeds)
    graph = stored(edges.join(owner, "pattern"), "pii-graph")
    # instances: 1 for seeds of the pattern's kind, 0 for other seeds and counter-examples
    score = None
    for _ in range(rounds):
        here = F.when(F.col("kind") == F.col("own"), 1.0).when(F.col("kind").isNotNull(), 0.0)
        rows = graph
        if score is not None:
            scored = graph.join(score, "pattern")
            known = (scored.where("kind is null").groupBy("hit", "own")
                     .agg(F.sum("score").alias("all"), F.count(F.lit(1)).alias("n")))
            rows = scored.join(known, ["hit", "own"], "left")
            here = here.otherwise(F.when(F.col("n") > 1, (F.col("all") - F.col("score")) / (F.col("n") - 1)).otherwise(0.0))
        else:
            here = here.otherwise(0.0)
        score = stored(rows.groupBy("pattern").agg(
            (F.sum(here) / (F.count(F.lit(1)) + 0.5)).alias("score")), "pii-scores")
    good = graph.join(score, "pattern").where((F.col("score") >= min_score) & F.col("kind").isNull())
    new = good.groupBy("hit").agg(F.max(F.struct("score", "own")).alias("b")).select("hit", F.col("b.own").alias("kind"))
    return found.join(new, "hit").select(*key, "start", "end", "kind")


def _keys(docs: DataFrame) -> list[Column]:
    return [F.col("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("sign")]


_KEY = ["doc_id", "sign"]


def _found(docs: DataFrame) -> DataFrame:
    texts = docs.select(*_keys(docs), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    return stored(matches(texts, _KEY, "t"), "pii-matches")


def _new_rows(found: DataFrame) -> DataFrame:
    """One row per span of the method: key, start, end, kind."""
    return discovered(stored(instances(found, _KEY), "pii-instances"), _KEY)


def _named(spans: DataFrame) -> DataFrame:
    return spans.withColumnsRenamed({"doc_id": "__id", "sign": "__sign"})


def _with(rows: DataFrame, spans: DataFrame) -> DataFrame:
    return rows.join(spans, rows["doc_id"].eqNullSafe(spans["__id"]) & (rows["sign"] == spans["__sign"]), "left") \
               .drop("__id", "__sign")


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts of the base kinds, base_sha256, spans."""
    prepare(docs.sparkSession)
    found = _found(docs)
    rows = _base_rows(found, _KEY).withColumn("own", F.lit(True)).unionByName(
        _new_rows(found).withColumn("own", F.lit(False)))
    both = _with(docs.select(*_keys(docs)), _named(_spans(rows, _KEY, base=F.col("own"), spans=F.lit(True))))
    empty = F.array().cast("array<struct<start:int,no:int,end:int,kind:string>>")
    both = both.withColumn("base", F.coalesce("base", empty)).withColumn("spans", F.coalesce("spans", empty))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return both.select("doc_id", *[count(k) for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                       _joined(F.col("spans")).alias("spans"))


def _masked(kind: str) -> Column:
    return F.transform("k_m", lambda m: F.when(_valid(kind, m), F.lit(MASKS[kind])).otherwise(m))


def _rebuilt(text: Column, cuts: Column) -> Column:
    """The text with a mark for each cut.  Pieces are cut from its UTF-32 bytes, where a position is an address: time
    grows with the text, not with text times cuts.  (The array of one evaluates the bytes once.)"""
    mark = F.create_map(*[F.lit(x) for kv in MASKS.items() for x in kv])

    def pieces(wide: Column) -> Column:
        def piece(k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(cuts, k - 1)["end"])
            end = F.when(k < F.size(cuts), F.get(cuts, k)["start"]).otherwise((F.octet_length(wide) / 4).cast("int"))
            own = F.decode(F.substring(wide, start * 4 + 1, (end - start) * 4), "UTF-32")
            return F.concat(own, F.when(k < F.size(cuts), mark[F.get(cuts, k)["kind"]]).otherwise(""))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(cuts)), piece), "")

    return F.transform(F.array(F.encode(text, "UTF-32")), pieces)[0]


def mask(docs: DataFrame) -> DataFrame:
    """The documents table with every span that ``find`` names replaced by its kind's mark, overlapping spans
    by one; ``n_chars``, if the table has it, follows the new text."""
    prepare(docs.sparkSession)
    found = _found(docs)
    cuts = _cuts(_base_rows(found, _KEY).union(_new_rows(found)), _KEY)
    rows = docs.select(rows_of(docs), *_keys(docs), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    rows = _with(rows, _named(cuts)).select("__row", "t", "cuts")
    rows = rows.withColumn("t", F.when(F.size("cuts") > 0, _rebuilt(F.col("t"), F.col("cuts"))).otherwise(F.col("t")))
    rows = rows.drop("cuts")
    # identifiers that came to light only when a neighbour was cut off
    for kind, regex in KINDS.items():
        rows = _split(rows, "t", "k", regex, GUARDS[kind])
        ok = _masked(kind)
        whole = F.array_join(F.flatten(F.transform(
            F.arrays_zip(F.col("k_p"), F.concat(ok, F.array(F.lit("")))),
            lambda x: F.array(x["k_p"], x["1"]))), "")
        rows = rows.withColumn("t", F.when(F.size("k_m") > 0, whole).otherwise(F.col("t"))).drop("k_m", "k_p")
    cols = []
    for c in docs.columns:
        own = F.col(f"__row.`{c}`")
        if c == "text":
            own = F.when(own.isNull(), own).otherwise(F.col("t"))
        elif c == "n_chars" and dict(docs.dtypes)[c] in ("int", "bigint"):
            own = F.when(own.isNull(), own).otherwise(F.length("t").cast(dict(docs.dtypes)[c]))
        cols.append(own.alias(c))
    return rows.select(*cols)

"""Personal data: candidate spans, boosted trees over format and context, calibrated thresholds
(DataFrame functions and pyspark.ml only).

Generators propose spans, which may overlap: the four base patterns, and a wider pattern of
each kind (written-out e-mail addresses, spaced or bracketed IP addresses, card numbers with
other separators, phone numbers without a country prefix). Base spans that pass their check
(IP parts, Luhn, digit counts) always stay. Every candidate gets a few small features of its
shape, its neighbours and the words before it; rows with equal features are counted, and
gradient boosted trees are trained on the counted table.

The (weak) label is evidence that the features don't show: the value itself. A candidate is confirmed if
its value, with ``(at)``, ``(dot)``, brackets, spaces and separators normalised, passes the
check of its kind (``valid``: a host that ends in letters, IP parts, Luhn and 13 to 19 digits,
10 to 15 digits), and either its exact form is one that people write (``form``: a written-out or
unspaced address, bracketed or evenly spaced IP parts, a card issuer's first digits in one piece or in
groups with one separator, an area code in parentheses or 3-3-4 digits) or a word before it
names its kind (``hint`` 2). Neither check nor form is a feature, so candidates of one shape and context
differ in their labels, and the trees learn how often such a thing is what it looks like: an order
number that passes Luhn by chance is among nine that don't, and none of them is taken; the same digits
after the word card are. For each kind the threshold is the lowest score at which, of the
wider candidates that overlap no base span and stand in documents that weren't trained on, at
least ``PRECISION`` of those at or above it are confirmed; where none of these scores as high,
all documents are asked. Wider candidates at or above the threshold that pass their check and overlap no
base span are added; of those that overlap each other the leftmost stays.

Positions are code points, end exclusive. Texts are searched whole, by patterns that can't
backtrack (possessive runs, anchored at the start of a run), so a long text costs linear time.

Defined cases: null or empty text: no span; null doc_id and repeated rows: one result row
each; only one label among the candidates: one score for all; no candidates: no span.
Only doc_id and text are read.
"""

from __future__ import annotations


from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import pinned, table

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
TREES, DEPTH = 10, 3
CONTEXT = 24            # characters before a span that features look at
_LOCAL = r"[A-Za-z0-9._%+-]"
#: By kind: the base pattern, then the wider one. Runs are possessive and begin where a run begins
#: (or where the last match ended), which finds what the plain pattern finds, without its retries.
PATTERNS = (
    rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    # ". " may only be the first dot of a host, as a sentence ends so, too
    rf"(?<!{_LOCAL}){_LOCAL}++\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]++\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++"
    r"(?:(?:\x20?(?:\(dot\)|\[dot\])\x20?|\x20\.\x20|\x20?\.)[A-Za-z0-9-]++)*+",
    r"(?<![0-9.])[0-9]{1,3}(?:\x20?\[?\.\]?\x20?[0-9]{1,3}){3}(?![0-9])",
    r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9])++",
    r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
)
FEATURES = ("kind", "digits", "pieces", "longest", "paren", "hyphen", "space", "dot", "before_class", "after_class", "hint")
_HINTS = r"(?i)(?:mail|contact|tel|phone|call|fax|mobile|card|visa|credit|pay|ip|host|server|addr)"
#: By kind: whole words before a span that name its kind.
_NAMES = (
    r"(?i)\b(?:e-?mails?|mailto|contact|write|reach)\b",
    r"(?i)\b(?:ip|ipv4|hosts?|servers?|addr|address|gateway|dns)\b",
    r"(?i)\b(?:cards?|visa|mastercard|amex|credit|debit|pay|paid|payment)\b",
    r"(?i)\b(?:tel|telephone|phones?|call|dial|fax|mobile|cell|contact)\b",
)


def _matches(text: Column, generator: int) -> Column:
    """Array of (generator, pos, lead: characters since the last match, value, before, after)."""
    pattern = F.lit(PATTERNS[generator])
    pieces = F.split(text, PATTERNS[generator], -1)
    around = F.zip_with(pieces, F.slice(pieces, 2, 1 << 30), lambda p, q: F.struct(
        F.char_length(p).alias("lead"), F.right(p, F.lit(CONTEXT)).alias("before"), F.left(q, F.lit(1)).alias("after")))
    both = F.filter(F.zip_with(around, F.regexp_extract_all(text, pattern, F.lit(0)), lambda a, m: F.struct(
        a["lead"].alias("lead"), a["before"].alias("before"), a["after"].alias("after"), m.alias("value"))),
        lambda x: x["value"].isNotNull())
    return F.transform(both, lambda x, i: F.struct(
        F.lit(generator).alias("generator"), i.alias("pos"), x["lead"].alias("lead"), x["value"].alias("value"),
        x["before"].alias("before"), x["after"].alias("after")))


def _luhn(digits: Column) -> Column:
    doubled = F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))
    figures = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.when(
        i % 2 == 0, F.get(doubled, F.substring(F.reverse(digits), i, F.lit(1)).cast("int")))
        .otherwise(F.substring(F.reverse(digits), i, F.lit(1)).cast("int")))
    total = F.aggregate(figures, F.lit(0), lambda a, x: a + x)
    return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), total % 10 == 0)


def _class(c: Column) -> Column:
    return (F.when(c == "", 0).when(c.rlike(r"[\x20\x09-\x0D]"), 1).when(c.rlike("[0-9]"), 2)
            .when(c.rlike("[A-Za-z]"), 3).otherwise(4))


def _by_kind(*conditions: Column) -> Column:
    """The condition of the row's kind; false where it is null."""
    chosen = F.lit(False)
    for k, c in enumerate(conditions):
        chosen = F.when(F.col("kind") == k, c).otherwise(chosen)
    return F.coalesce(chosen, F.lit(False))


def _valid() -> Column:
    """Does the value, normalised, pass the check of its kind?"""
    value = F.col("value")
    address = F.regexp_replace(F.regexp_replace(value, r"\x20?(?:\(at\)|\[at\])\x20?|\x20?@\x20?", "@"),
                               r"\x20?(?:\(dot\)|\[dot\]|\.)\x20?", ".")
    parts = F.split(F.regexp_replace(value, r"[\x20\[\]]", ""), r"\.")
    return _by_kind(
        address.rlike(rf"^{_LOCAL}++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{{2,24}}$") & ~value.rlike(r"\.\x20[A-Z]"),
        (F.size(parts) == 4) & F.forall(parts, lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255),
        F.col("luhn") == 1, F.length("figures").between(10, 15))


def _form() -> Column:
    """Does the way the value is written speak for its kind?"""
    value, alone = F.col("value"), ~F.col("before").rlike(r"[0-9A-Za-z][./_-]$")
    whole = value.rlike(r"^[0-9]++$") | value.rlike(r"^[0-9]{3,6}([\x20./_-]{1,2})[0-9]{3,6}(?:\1[0-9]{1,7})+$")
    return _by_kind(
        value.rlike(r"\(at\)|\[at\]|\(dot\)|\[dot\]") | ~value.rlike(r"\x20\.|\.\x20"),
        value.rlike(r"[\[\]]") | value.rlike(r"^[0-9]++(?:\.[0-9]++){3}$|^[0-9]{2,3}(?:\x20\.\x20[0-9]{1,3}){3}$"),
        alone & whole & F.col("figures").rlike("^(?:[3-6]|2[2-7])") & ((F.length("figures") > 13) | F.col("figures").startswith("4")),
        value.startswith("+") | value.rlike(r"^\([0-9]{2,4}\)") | alone & value.rlike(r"^[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}$"))


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row of ``docs`` with a number of its own (rid), and every proposed span with
    its kind, position, whether it is a base span that passes its check (ok), and its features."""
    text = F.coalesce("text", F.lit(""))
    may = {0: text.contains("@"), 4: text.rlike(r"@|\(at\)|\[at\]")}
    digit = text.rlike("[0-9]")
    none = F.array().cast("array<struct<generator:int,pos:int,lead:int,value:string,before:string,after:string>>")
    found = pinned(docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id",
        F.concat(*[F.when(may.get(g, digit), _matches(text, g)).otherwise(none) for g in range(len(PATTERNS))])
        .alias("hits")))
    run = Window.partitionBy("rid", "generator").orderBy("pos")
    spans = (found.select("rid", "doc_id", F.inline("hits"))
             .withColumn("end", F.sum(F.col("lead") + F.char_length("value")).over(run))
             .withColumn("start", F.col("end") - F.char_length("value"))
             .withColumn("kind", F.col("generator") % len(KINDS))
             .withColumn("figures", F.regexp_replace("value", "[^0-9]", ""))
             .withColumn("digits", F.least(F.length("figures"), F.lit(20)))
             .withColumn("luhn", F.when(F.col("kind") == 2, _luhn(F.col("figures"))).otherwise(F.lit(False)).cast("int")))
    parts = F.split("value", r"\.")
    small = F.forall(parts, lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                     & (F.coalesce(F.right(p, F.lit(3)).try_cast("int"),
                                   F.lit(0)) <= 255))
    check = (F.when(F.col("generator") == 0, True)
             .when(F.col("generator") == 1, small)
             .when(F.col("generator") == 2, F.length("figures").between(14, 19) & (F.col("luhn") == 1))
             .when(F.col("generator") == 3, F.length("figures").between(10, 15)).otherwise(False))
    has = lambda c: F.contains(F.col("value"), F.lit(c)).cast("int")
    spans = (spans.withColumn("ok", F.coalesce(check, F.lit(False)))
             .withColumn("pieces", F.least(F.size(F.split("value", r"[^0-9A-Za-z]+")), F.lit(6)))
             .withColumn("longest", F.coalesce(F.array_max(F.transform(F.regexp_extract_all("value", F.lit("[0-9]++"), F.lit(0)), F.length)), F.lit(0)))
             .withColumn("longest", F.least(F.col("longest"), F.lit(14)))
             .withColumn("paren", has("(")).withColumn("hyphen", has("-")).withColumn("space", has(" "))
             .withColumn("dot", has(".")).withColumn("before_class", _class(F.right("before", F.lit(1))))
             .withColumn("after_class", _class(F.coalesce("after", F.lit(""))))
             .withColumn("hint", F.when(_by_kind(*[F.col("before").rlike(n) for n in _NAMES]), 2)
                         .when(F.col("before").rlike(_HINTS), 1).otherwise(0))
             .withColumn("valid", _valid().cast("int")).withColumn("form", _form().cast("int"))
             .withColumn("label", F.col("ok") | (F.col("valid") == 1) & ((F.col("form") == 1) | (F.col("hint") == 2))))
    # does the span overlap a checked base span of any kind?
    w = Window.partitionBy("rid").orderBy("start")
    reach = F.max(F.when(F.col("ok"), F.col("end"))).over(w.rangeBetween(Window.unboundedPreceding, 0))
    # from the end of the text, as a frame that ends at the last row is taken anew for every row
    back = Window.partitionBy("rid").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    ahead = F.min(F.when(F.col("ok"), F.col("start"))).over(back)
    spans = spans.withColumn("taken", F.coalesce(reach > F.col("start"), F.lit(False))
                             | F.coalesce(ahead < F.col("end"), F.lit(False)))
    # of every base match that passed its check and the wider ones, what the rest needs
    spans = spans.filter(F.col("ok") | (F.col("generator") != 0)).select(
        "rid", "doc_id", "generator", "kind", "start", "end", "ok", "valid", "label", "taken",
        *[F.col(f) for f in FEATURES if f != "kind"])
    return found.select("rid", "doc_id"), pinned(spans)


def thresholds(spans: DataFrame) -> DataFrame | None:
    """Per combination of features that occurs: whether candidates with it are selected (columns FEATURES, chosen)."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 3
    wider = F.col("generator") >= len(KINDS)
    learned, label = ~fold, F.col("label")
    # wider candidates within base spans can't be added; the base candidate speaks for both
    cells = pinned(spans.filter(~(wider & F.col("taken"))).groupBy(*FEATURES).agg(
        F.count_if(learned).alias("n"), F.count_if(learned & label).alias("yes"),
        F.count_if(wider & fold).alias("n_cal"), F.count_if(wider & fold & label).alias("yes_cal"),
        F.count_if(wider).alias("n_all"), F.count_if(wider & label).alias("yes_all")).coalesce(1))
    seen = cells.agg(F.sum("yes"), F.sum("n") - F.sum("yes"), F.count("*")).first()
    if not seen[2]:
        return None
    if seen[0] and seen[1]:
        assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(cells)
        labelled = (assembled.select("features", F.explode(F.array(
            F.struct(F.lit(1.0).alias("label"), F.col("yes").cast("double").alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (F.col("n") - F.col("yes")).cast("double").alias("weight")))).alias("y"))
            .select("features", "y.*").filter("weight > 0"))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, weightCol="weight", seed=7).fit(labelled)
        scored = model.transform(assembled).withColumn("score", vector_to_array("probability")[1])
    else:
        scored = cells.withColumn("score", F.lit(0.5))
    # bounded windows: one row per combination of features
    falling = Window.partitionBy("kind").orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, 0)
    above = {c: F.sum(c).over(falling) for c in ("n_cal", "yes_cal", "n_all", "yes_all")}
    scored = scored.withColumn("good", F.when(above["n_cal"] > 0, above["yes_cal"] >= PRECISION * above["n_cal"])
                               .otherwise((above["n_all"] > 0) & (above["yes_all"] >= PRECISION * above["n_all"])))
    limit = F.min(F.when(F.col("good"), F.col("score"))).over(Window.partitionBy("kind"))
    return scored.select(*FEATURES, F.coalesce(F.col("score") >= limit, F.lit(False)).alias("chosen"))


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and spans (arrays of start, kind, end in that order)."""
    rows, spans = candidates(docs)
    place = F.struct("start", "kind", "end")
    kept = spans.filter("ok").select("rid", place.alias("span"), F.lit(True).alias("base"))
    chosen = thresholds(spans)
    if chosen is not None:
        line = Window.partitionBy("rid").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, -1)
        wider = (spans.filter(f"generator >= {len(KINDS)} and valid = 1 and not taken").join(chosen.filter("chosen"), list(FEATURES))
                 .select("rid", "start", "kind", "end").distinct()
                 .withColumn("reach", F.max("end").over(line)).filter("reach is null or reach <= start"))
        kept = kept.union(wider.select("rid", place.alias("span"), F.lit(False).alias("base")))
    per_row = kept.groupBy("rid").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base"),
        F.array_sort(F.collect_list("span")).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.join(per_row, "rid", "left").select(
        "doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span of ``find`` replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    done = F.aggregate(spans, start, lambda a, s: F.when(s["start"] < a["at"], F.struct(
        a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(F.struct(
            F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                     F.get(names, s["kind"])).alias("out"), s["end"].alias("at"))))
    return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_pii(spark, sf_dir):
    """Personal data in every document of ``documents``."""
    found = find(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}")
              for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))

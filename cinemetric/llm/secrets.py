"""Operator 9: secret scan with a random forest that removes false positives (native).

Candidates are of three kinds: runs of six or more characters, whatever they are but white space
and quotes, that are assigned to a name that announces a secret (without closing punctuation if
not quoted); passwords between ``user:`` and ``@`` of a URL; and elsewhere long runs of the
characters that keys are made of.  Each is described by columns over the candidate and its
surroundings: length, character classes and transitions between them, distinct characters (of
the first 256), coverage by a dictionary, path-likeness and the neighbouring words.  The dictionary
is the corpus's own: the ``DICTIONARY_WORDS`` most frequent words around all its candidates, beside
common word endings.  A random forest trained from
labelled findings scores them and drops false positives.  A password of letters alone, or one
without a name or URL in front, cannot be told from a word by these columns and is not promised.

The forest is compiled into one Spark SQL expression, so a scan is a projection: one pass of the
pattern parts a text into candidates and what lies between them, features and scores are arrays
inside its row, nothing is shuffled, and Python only builds expressions.  ``extracted`` candidates
are stored once for training and scoring.

Labels: there is no table of findings; the corpus gives those whose label is beyond doubt, the seeds
those of textbook form.  ``held_out_quality`` trains on three quarters of them and measures
precision and recall on the rest.

Defined cases: null and empty texts have no findings; a text that is one long run is one
candidate; repeated rows are scanned each for itself; columns of any name stay as they are; without labelled findings of both kinds in
the corpus the seed findings alone train the forest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinemetric.llm.shared import stored, work_dir

CONTEXT = 48
MASK = "[SECRET]"
#: Labelled corpus findings that the forest learns from at most, of each kind.
SAMPLE_FINDINGS = 4_000
#: Words of the corpus that the dictionary holds at most.
DICTIONARY_WORDS = 256
#: Private-use characters that part a text; a text that holds one is parted in two passes.
_OPEN, _CLOSE = "\ue000", "\ue001"
#: Names that announce a secret, names that announce something else, common words.
SECRET_NAMES = "key|token|secret|passw|passwd|pwd|auth|credential|bearer|private|signature"
OTHER_NAMES = "commit|sha1|sha256|md5|hash|checksum|digest|uuid|guid|revision|example|dummy|sample|placeholder|order|isbn|phone"
_NAMED = rf"(?i:{SECRET_NAMES})[A-Za-z0-9_\-]{{0,24}}[\"']?\s{{0,4}}[=:]"
#: Holds in every text that has a candidate of the first two kinds; looks back from signs only.
SIGNED = rf"[=:](?:(?<={_NAMED})|(?<=://[^\s:/@\"']{{0,64}}:))"
RUN = r"[A-Za-z0-9_\-+/.]{16,}={0,2}"
_ASSIGNED = rf"(?<={_NAMED}[=:]?>?\s{{0,4}}[\"']?)(?![A-Za-z][A-Za-z0-9+.\-]{{0,15}}://|\$\{{[A-Za-z0-9_.]+\}}(?:[\s\"',;.)]|$))"
#: All three kinds; the looks back of one character come first, so that most places fail at once.
CANDIDATE = (
    rf"(?<=[\"'])(?<=[=:>]\s{{0,4}}[\"']){_ASSIGNED}[^\s\"']{{6,}}"
    rf"|(?<=[=:>\s])(?<=[=:>]\s{{0,4}}){_ASSIGNED}[^\s\"']{{5,}}[^\s\"',;.:)\]}}>]"
    rf"|(?<=:)(?<=://[^\s:/@\"']{{0,64}}:)[^\s/\"']{{3,}}(?=@)"
    rf"|{RUN}"
)
#: Fixed value: common endings and parts of words and paths.
DICTIONARY = (
    "tion|ment|ness|able|ible|ation|ence|ance|ing|the|and|for|that|with|this|from|have|not|are|was|were|which|"
    "ung|heit|keit|lich|isch|schaft|einer|nicht|und|der|die|das|eux|eau|aux|ique|mente|ado|ción|que|los|las|des|"
    "file|path|home|user|data|test|your|here|change|http|https|www|com|html|json|index|image|static"
)
FEATURES = (
    "length", "digits", "capitals", "lowers", "marks", "hex_only", "transitions", "distinct",
    "dictionary", "slashes", "dots", "vowels", "assigned", "secret_name", "other_name", "quoted", "path", "in_url", "reference",
)


@dataclass(frozen=True)
class Forest:
    """A compiled forest: SQL over a struct ``c`` of ``FEATURES``, and the dictionary's pattern."""

    sql: str
    dictionary: str = DICTIONARY


def _share(of: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(of, f"[^{pattern}]", "")) / F.length(of)


def features(secret: Column, before: Column, after: Column, dictionary: str) -> list[Column]:
    """The columns of ``FEATURES`` of one candidate, all doubles."""
    n = F.length(secret)
    # one letter per character class, runs squeezed: what is left counts the transitions
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(secret, "[A-Z]+", "\u0001"), "[a-z]+", "\u0002"), "[0-9]+", "\u0003")
    lead = F.lower(before)
    values = {
        "length": F.least(n, F.lit(256)),
        "digits": _share(secret, "0-9"),
        "capitals": _share(secret, "A-Z"),
        "lowers": _share(secret, "a-z"),
        "marks": _share(secret, r"_\-+/=."),
        "hex_only": secret.rlike("^[0-9a-fA-F]+$"),
        "transitions": F.length(kinds) / n,
        "distinct": F.size(F.array_distinct(F.split(F.substring(secret, 1, 256), ""))) / F.least(n, F.lit(64)),
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(secret), dictionary, "")) / n,
        "slashes": _share(secret, "/"),
        "dots": _share(secret, "."),
        "vowels": _share(F.lower(secret), "aeiou"),
        "assigned": lead.rlike(r"[=:]\s*[\"']?$"),
        "secret_name": lead.rlike(f"({SECRET_NAMES})[a-z0-9_]*[\"']?\\s*[=: ]\\s*[\"']?$"),
        "other_name": lead.rlike(f"({OTHER_NAMES})[a-z0-9_]*[\"']?\\s*[=: ]?\\s*[\"']?$"),
        "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
        "in_url": before.rlike("://[^\\s:/@\"']*:$") & after.rlike("^@"),
        # a variable, a call, a tag or a blank in a template rather than a value
        "reference": secret.rlike(r"^(\$[A-Za-z_({]|%\(|<|\{|\[|os\.|self\.|[A-Za-z_.]+[(\[])|(?i:your|example|changeme|xxxx|\*\*\*\*)"),
        "path": secret.rlike(r"^(/|\./|www\.|http)|/.*/|\.(com|org|net|html?|json|py|txt|png|jpg)\b"),
    }
    return [values[f].cast("double").alias(f) for f in FEATURES]


def _by_kind(text: Column, of) -> Column:
    """``of`` the pattern that a text needs: most texts hold no sign behind a name."""
    return F.when(text.rlike(SIGNED), of(CANDIDATE)).otherwise(of(RUN))


def _parts(text: Column) -> Column:
    """A text in turns of what lies between candidates and a candidate, beginning and ending with the
    former (one part: no candidate)."""

    def of(pattern: str) -> Column:
        marked = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), f"[{_OPEN}{_CLOSE}]", -1)
        found = F.concat(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array(F.lit("")))
        turns = F.flatten(F.zip_with(F.split(text, pattern, -1), found, lambda gap, secret: F.array(gap, secret)))
        return F.when(text.rlike(f"[{_OPEN}{_CLOSE}]"), F.slice(turns, 1, F.size(turns) - 1)).otherwise(marked)

    return _by_kind(text, of)


def _candidates(parts: Column) -> Column:
    """Array of ``(secret, before, after, gap)``: ``gap`` is the length of what lies in front."""

    def one(i: Column) -> Column:
        at = lambda k: F.get(parts, 2 * i + k)
        # a candidate in front of this one can hold its name
        return F.struct(
            at(1).alias("secret"), F.substring(F.concat(F.coalesce(at(-1), F.lit("")), at(0)), -CONTEXT, CONTEXT).alias("before"),
            F.substring(at(2), 1, CONTEXT).alias("after"), F.length(at(0)).alias("gap"),
        )

    return F.transform(F.sequence(F.lit(0), F.floor(F.size(parts) / 2).cast("int") - 1), one)


def extracted(docs: DataFrame, doc_id: str | None = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, found``: the candidates of every text that has one (``doc_id`` may be left out)."""
    rows = docs.select((F.col(f"`{doc_id}`") if doc_id else F.lit(None)).alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    parted = rows.select("doc_id", _parts(F.col("text")).alias("parts")).filter(F.size("parts") > 1)
    return parted.select("doc_id", _candidates(F.col("parts")).alias("found"))


def corpus_dictionary(found: DataFrame) -> str:
    """The pattern of the words around the candidates of ``extracted`` rows, longest first, and common endings."""
    near = found.select(F.explode("found").alias("c")).select(F.lower(F.concat_ws(" ", "c.before", "c.after")).alias("t"))
    words = near.select(F.explode(F.regexp_extract_all("t", F.lit(r"\p{L}{4,}"), F.lit(0))).alias("w")).groupBy("w").count()
    top = [r["w"] for r in words.orderBy(F.col("count").desc(), "w").limit(DICTIONARY_WORDS).collect()]  # bounded
    return "|".join(sorted({*top, *DICTIONARY.split("|")}, key=lambda w: (-len(w), w)))


def seed_findings(spark: SparkSession, rows: int = 1_200) -> DataFrame:
    """Labelled findings of textbook form, ``(secret, before, after, label)``: keys of several
    makes behind names that announce them, and hashes, paths, words, numbers and identifiers."""
    i = F.col("id")
    a, b = F.sha1(F.concat(F.lit("a"), i.cast("string"))), F.md5(F.concat(F.lit("b"), i.cast("string")))
    mixed = F.regexp_replace(F.substring(F.base64(F.unhex(F.concat(a, b))), 1, 40), "=", "")
    name = F.element_at(F.array(*map(F.lit, ["api_key", "token", "secret", "password", "auth_token", "client_secret"])), (i % 6 + 1).cast("int"))
    sign = F.element_at(F.array(*map(F.lit, [' = "', ": ", "=", ' := "', ": '"])), (i % 5 + 1).cast("int"))
    close = F.when(sign.endswith('"'), F.lit('" ')).when(sign.endswith("'"), F.lit("' ")).otherwise(F.lit(" "))
    word = F.translate(F.substring(a, 1, 18), "0123456789abcdef", "aeiourstnlthendi")
    good = [(a, F.concat(F.lit("x "), name, sign), close), (mixed, F.concat(F.lit("the "), name, sign), close), (b, F.concat(name, sign), close)]
    # passwords: short, with marks, and in URLs
    mark = lambda k: F.substring(F.lit("@!$%#&~*?+^@!$%#&~*?+^"), ((i + k) % 11 + 1).cast("int"), F.lit(1))
    pass_name = F.element_at(F.array(*map(F.lit, ["password", "pwd", "passwd", "db_password", "user_passwd", "secret"])), (i % 6 + 1).cast("int"))
    letters = F.initcap(F.translate(F.substring(a, 1, 6), "0123456789abcdef", "aeiourstnlthendi"))
    short = F.substring(mixed, 3, 12)
    marked = F.concat(letters, F.substring(b, 1, 2), mark(0), F.conv(F.substring(b, 3, 2), 16, 10))
    broken = F.concat(F.substring(mixed, 1, 9), mark(1), F.substring(mixed, 10, 8), mark(2), F.substring(mixed, 20, 7))
    worded = F.concat(F.lower(letters), F.conv(F.substring(b, 5, 1), 16, 10), F.substring(mixed, 5, 2), F.lit("y9"))
    good += [(x, F.concat(lead, pass_name, sign), close) for x, lead in ((short, F.lit("x ")), (marked, F.lit("the ")), (broken, F.lit("")), (worded, F.lit("in ")))]
    user = F.concat(F.element_at(F.array(*map(F.lit, ["postgres://", "https://", "redis://"])), (i % 3 + 1).cast("int")), F.lower(letters), F.lit(":"))
    good += [(x, F.concat(F.lit("at "), user), F.lit("@db.host/x ")) for x in (F.substring(mixed, 7, 5), marked, worded)]
    plain = F.lit("and the ")
    bad = [
        (word, plain, F.lit(" of")),
        (F.substring(F.translate(a, "abcdef", "012345"), 1, 16), plain, F.lit(" in")),
        (a, F.lit("see commit "), F.lit(".")),
        (b, F.lit("the md5 checksum: "), F.lit("\n")),
        (F.concat(F.lit("/home/user/data/"), word, F.lit(".txt")), F.lit("open "), F.lit(" ")),
        (F.concat(F.lit("www."), F.substring(word, 1, 9), F.lit(".com/index.html")), F.lit("at "), F.lit(" ")),
        (F.concat(F.substring(b, 1, 8), F.lit("-"), F.substring(b, 9, 4), F.lit("-"), F.substring(b, 13, 4), F.lit("-"), F.substring(b, 17, 12)), F.lit("uuid "), F.lit(" ")),
        (F.lit("your_api_key_goes_here"), F.concat(name, sign), close),
        (F.lit("----------------------------"), plain, F.lit("\n")),
        (F.substring(word, 1, 6), F.concat(F.lit("x "), pass_name, sign), close),
        (F.concat(F.substring(word, 1, 9), F.lit("ing")), F.concat(F.lit("the "), name, sign), close),
        (F.concat(F.substring(word, 1, 5), F.lit("_"), F.substring(word, 6, 6)), F.concat(pass_name, sign), close),
        (F.concat(F.substring(word, 1, 5), F.lit("("), F.substring(word, 6, 5), F.lit(")")), F.concat(pass_name, sign), close),
        (F.concat(F.lit("${"), F.upper(F.substring(word, 1, 9)), F.lit("}")), F.concat(pass_name, sign), close),
        (F.concat(F.lit("${"), F.upper(F.substring(word, 1, 9))), F.concat(name, F.lit(": ")), F.lit("} ")),
        (F.concat(F.lit("<your-"), pass_name, F.lit("123>")), F.concat(pass_name, sign), close),
        (F.lit("********"), F.concat(pass_name, sign), close),
    ]
    rowset = [
        F.struct(s.alias("secret"), l.alias("before"), r.alias("after"), F.lit(label).alias("label"))
        for label, group in ((1, good), (0, bad))
        for s, l, r in group
    ]
    return spark.range(rows // len(rowset) + 1).select(F.explode(F.array(*rowset)).alias("f")).select("f.*")


def corpus_findings(found: DataFrame, per_kind: int = SAMPLE_FINDINGS) -> DataFrame:
    """Candidates of ``extracted`` rows whose label is beyond doubt: a random value assigned to a secret's
    name, or one that is all letters or all digits.  At most ``per_kind`` distinct ones of each kind,
    by smallest hash."""
    rows = found.select(F.explode("found").alias("c")).select("c.secret", "c.before", "c.after")
    s, lead = F.col("secret"), F.lower(F.col("before"))
    sure = F.when(
        lead.rlike(f"({SECRET_NAMES})[a-z0-9_]*\\s*[=:]\\s*[\"']$") & s.rlike("[0-9]") & s.rlike("[A-Za-z]") & (F.length(s) >= 20) & ~s.rlike("(?i)example|your"), 1
    ).when(s.rlike("^([A-Za-z]+|[0-9]+)[.]?$"), 0)
    labelled = rows.withColumn("label", sure).filter(F.col("label").isNotNull())
    order = [F.xxhash64("secret", F.lit(5)), "secret", "before", "after"]
    parts = [labelled.filter(F.col("label") == k).distinct().orderBy(*order).limit(per_kind) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(findings: DataFrame, dictionary: str = DICTIONARY, trees: int = 16, depth: int = 6, seed: int = 17) -> Forest:
    """Fit the forest to ``(secret, before, after, label)`` and compile it into SQL over a struct
    ``c`` of ``FEATURES``: the mean share of secrets in the leaves that a candidate reaches."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = findings.select(F.col("label").cast("double").alias("y"), *features(F.col("secret"), F.col("before"), F.col("after"), dictionary))
    rows = stored(rows, work_dir(findings.sparkSession, "findings")).coalesce(4)  # bounded: see SAMPLE_FINDINGS
    x = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows)
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=seed).fit(x)

    def sql(node) -> str:
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            total = sum(stats)
            return f"{(stats[1] / total if total else 0.0) if len(stats) > 1 else 0.0!r}D"
        split = node.split()
        return f"IF(c.{FEATURES[split.featureIndex()]} <= {split.threshold()!r}D, {sql(node.leftChild())}, {sql(node.rightChild())})"

    return Forest(f"({' + '.join(sql(t._call_java('rootNode')) for t in forest.trees)}) / {len(forest.trees)}D", dictionary)


def _labelled(found: DataFrame) -> DataFrame:
    return corpus_findings(found).unionByName(seed_findings(found.sparkSession))


def forest_of(found: DataFrame) -> Forest:
    """The forest for a corpus, from its ``extracted`` candidates."""
    return train(_labelled(found), corpus_dictionary(found))


def default_forest(docs: DataFrame, text: str = "text") -> Forest:
    return forest_of(stored(extracted(docs, None, text).select("found"), work_dir(docs.sparkSession, "candidates")))


def _scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """``found`` as ``(secret, gap, score)`` of every candidate."""
    described = F.transform(
        "found", lambda c: F.struct(c["secret"].alias("secret"), c["gap"].alias("gap"), F.struct(*features(c["secret"], c["before"], c["after"], forest.dictionary)).alias("f"))
    )
    score = f"transform(found, d -> named_struct('secret', d.secret, 'gap', d.gap, 'score', element_at(transform(array(d.f), c -> {forest.sql}), 1)))"
    return rows.withColumn("found", described).withColumn("found", F.expr(score))


def held_out_quality(found: DataFrame, threshold: float = 0.5) -> dict[str, float]:
    """Precision and recall on the quarter of the labelled findings that the forest has not seen."""
    rows = stored(_labelled(found).distinct(), work_dir(found.sparkSession, "labelled"))
    held = F.pmod(F.xxhash64("secret", "before", "after", F.lit(3)), F.lit(4)) == 0
    forest = train(rows.filter(~held), corpus_dictionary(found))
    unseen = rows.filter(held).select("label", F.array(F.struct("secret", "before", "after", F.lit(0).alias("gap"))).alias("found"))
    hit, secret = F.col("found")[0]["score"] >= threshold, F.col("label") == 1
    r = _scored(unseen, forest).agg(
        F.count_if(hit & secret).alias("tp"), F.count_if(hit & ~secret).alias("fp"), F.count_if(~hit & secret).alias("fn"), F.count(F.lit(1)).alias("n")
    ).first()
    return {"precision": r["tp"] / max(1, r["tp"] + r["fp"]), "recall": r["tp"] / max(1, r["tp"] + r["fn"]), "findings": r["n"]}


def findings_of(found: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """One row per secret of ``extracted`` candidates: ``doc_id, start, length, score, secret_sha256``
    (character offsets: running sums over the candidates of one text, keyed by the row)."""
    rows = _scored(found, forest).filter(F.exists("found", lambda c: c["score"] >= threshold))
    # numbered before the explode: all candidates of a text share its number
    each = rows.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", F.posexplode("found").alias("i", "c"))
    so_far = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.select("doc_id", "c.secret", "c.score", (F.sum(F.col("c.gap") + F.length("c.secret")).over(so_far) - F.length("c.secret")).alias("start"))
    return placed.filter(F.col("score") >= threshold).select(
        "doc_id", "start", F.length("secret").cast("long").alias("length"), "score", F.sha2("secret", 256).alias("secret_sha256")
    )


def findings(docs: DataFrame, forest: Forest, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    return findings_of(extracted(docs, doc_id, text), forest, threshold)


def redacted(docs: DataFrame, forest: Forest, text: str = "text", threshold: float = 0.5, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; other texts stay as they are."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    parted = packed.withColumn("parts", _parts(F.col("text")))
    none = F.array().cast("array<struct<secret:string,before:string,after:string,gap:int>>")
    scored = _scored(parted.withColumn("found", F.when(F.size("parts") > 1, _candidates(F.col("parts"))).otherwise(none)), forest)
    turns = F.transform(
        "found", lambda c, i: F.concat(F.get("parts", 2 * i), F.when(c["score"] >= threshold, F.lit(mask)).otherwise(c["secret"]))
    )
    joined = F.concat(F.array_join(turns, ""), F.element_at("parts", -1))
    secret = F.exists("found", lambda c: c["score"] >= threshold)
    shown = F.when(secret, joined).otherwise(F.col("text"))
    return scored.withColumn("shown", shown).select(*[F.col("shown").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in names])

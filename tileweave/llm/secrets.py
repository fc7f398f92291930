"""Operator 2: secret scans, with column functions only.

Candidates are long tokens with a digit, values after an asking word or in quotes after an assignment, passwords in
addresses, and blocks of private keys. A random forest, trained on labelled findings, throws out false positives by the
candidate's length, character transitions, dictionary coverage, path and neighbouring words. How likely one character
follows another, and which words a dictionary holds, is learned from the texts; what a neighbouring word says, from the
findings. Forest and tables become SQL expressions, so scanning and masking are projections: they read each text once, where
it lies, and shuffle nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileweave.llm.common import cut, drop

#: Words that ask for a secret, and words that name what only looks like one (fixed values).
ASKING = "pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth|bearer"
DENYING = "commit|sha(?:1|256|512)?|md5|checksum|digest|hash|etag|revision|order|invoice|card|phone|call|isbn|number|uuid|version"
#: What may be a secret. Look-behinds start with one character, so that most places fail at once; they must have a bound: a
#: user name of up to 64 characters before a password, up to 8 blanks on either side of an assignment. A key block's title has
#: up to three words. What goes beyond these is a candidate only if another line of the pattern finds it.
CANDIDATE = "|".join(
    [
        # a block of a private key
        r"-----BEGIN (?:[A-Z0-9]{2,12} ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}(?:-----END (?:[A-Z0-9]{2,12} ){0,3}PRIVATE KEY-----)?",
        # the password of an address
        r"(?<=:)(?<=://[^\s:/@]{1,64}:)[^\s@/]{4,}(?=@)",
        # in quotes after an assignment
        r"(?<=[\"'])(?<=[=:][ \t]{0,8}[\"'])[^\s\"']{8,}",
        # after an asking word and an assignment
        rf"(?<=[=: \t])(?<=[=:][ \t]{{0,8}})(?<=(?i:{ASKING})[A-Za-z_]{{0,8}}[\"']?[ \t]{{0,8}}[=:][ \t]{{0,8}})[^\s\"'<>,;]{{6,}}",
        # 16 or more token characters with a digit among them
        r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{16,}={0,2}",
    ]
)
#: Words of placeholders (fixed values).
PLACEHOLDER = "example|sample|placeholder|changeme|change|replace|dummy|fake|test|demo|your|here|none|null|xxxx|todo"
MASK = "[SECRET]"
#: Characters whose transitions are counted; all others are one more.
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"

FEATURES = ("length", "digits", "upper", "marks", "distinct", "runs", "transitions", "worst", "dictionary", "placeholder", "asked", "denied", "neighbours", "assigned", "quoted", "hex", "numeric", "path", "repeats", "address", "block")


@dataclass
class Language:
    """What ordinary words look like: log-likelihood of each character after each, and common words."""

    transitions: list[float]
    words: list[str]


def learn_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 1500) -> Language:
    """Transitions and the commonest words of four letters or more, counted over all documents, read whole.

    What comes to the driver is one count for each pair of characters and `words` words. An empty table gives a flat model.
    """
    # one pass over the texts; words meet with their counts only
    each = cut(docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}]+")).alias("w")).where("length(w) > 1").groupBy("w").agg(F.count("*").alias("n")))
    common = [r["w"] for r in each.where("length(w) > 3").orderBy(F.desc("n"), "w").limit(words).collect()]
    pairs = each.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", i, F.lit(2)))).alias("p")).groupBy("p").agg(F.sum("n").alias("n"))
    size = len(LETTERS) + 1
    counts = [[0.5] * size for _ in range(size)]
    for r in pairs.select(_place(F.substring("p", 1, 1)).alias("a"), _place(F.substring("p", 2, 1)).alias("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        counts[r["a"]][r["b"]] += r["n"]
    drop(each)
    return Language([round(math.log(x / sum(row)), 4) for row in counts for x in row], common)


def _place(c: Column) -> Column:
    """A character's place in LETTERS, or one more than the last."""
    at = F.position(c, F.lit(LETTERS))
    return F.when(at > 0, at - 1).otherwise(len(LETTERS))


def _share(value: Column, pattern: str) -> Column:
    """Share of value's characters in matches of pattern."""
    return 1 - F.length(F.regexp_replace(value, pattern, "")) / F.greatest(F.length(value), F.lit(1))


def _words_before(before: Column) -> Column:
    """The last three words of what stands before a candidate."""
    words = F.filter(F.split(F.lower(before), r"[^\p{L}]+"), lambda w: w != "")
    return F.slice(words, F.greatest(F.size(words) - 2, F.lit(1)), F.lit(3))


def _held(values, kind: str) -> Column:
    """Words or numbers without blanks as one array, split from one literal: plans of thousands of literals fill the driver."""
    return F.split(F.lit(" ".join(map(str, values))), " ").cast(f"array<{kind}>")


def _features(value: Column, before: Column, after: Column, path: Column, language: Language, odds: dict[str, float]) -> list[Column]:
    """The features of one candidate as doubles, never null, in the order of FEATURES."""
    low, n = F.lower(value), F.greatest(F.length(value), F.lit(1))
    runs = value
    for group, one in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0")):
        runs = F.regexp_replace(runs, group, one)
    table = _held(language.transitions, "double")
    chars = F.split(low, "")
    step = lambda a, b: F.get(table, (_place(a) * (len(LETTERS) + 1) + _place(b)).cast("int"))
    steps = F.when(F.length(low) > 1, F.zip_with(F.slice(chars, F.lit(1), F.length(low) - 1), F.slice(chars, F.lit(2), F.length(low) - 1), step))
    mean = F.aggregate(steps, F.lit(0.0), lambda a, v: a + v) / F.size(steps)
    known = _held(language.words, "string") if language.words else F.array().cast("array<string>")
    parts = F.filter(F.split(F.regexp_replace(value, "([a-z])([A-Z])", "$1 $2"), r"[^\p{L}]+"), lambda w: F.array_contains(known, F.lower(w)))
    told = F.transform(_words_before(before), lambda w: F.coalesce(F.element_at(F.map_from_arrays(_held(odds, "string"), _held(odds.values(), "double")), w), F.lit(0.0))) if odds else F.array().cast("array<double>")
    found = {
        "length": F.length(value),
        "digits": _share(value, "[0-9]"),
        "upper": _share(value, "[A-Z]"),
        "marks": _share(value, "[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(low, ""))) / n,
        "runs": F.length(runs) / n,
        "transitions": mean,
        "worst": F.array_min(steps),
        "dictionary": F.aggregate(parts, F.lit(0), lambda a, w: a + F.length(w)) / n,
        "placeholder": low.rlike(PLACEHOLDER),
        "asked": before.rlike(f"(?i)(?:{ASKING})"),
        "denied": before.rlike(f"(?i)\\b(?:{DENYING})\\b"),
        "neighbours": F.aggregate(told, F.lit(0.0), lambda a, v: a + v),
        "assigned": before.rlike("[=:]\\s*[\"']?$"),
        "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
        "hex": value.rlike("^[0-9a-fA-F]+$"),
        "numeric": value.rlike("^[0-9]+$"),
        "path": F.coalesce(path.cast("string"), F.lit("")).rlike("(?i)test|example|sample|mock|fixture|docs?/"),
        "repeats": value.rlike("(.)\\1{3,}|(..)\\2{2,}|(...)\\3{2,}"),
        "address": before.rlike("://[^\\s:/@]+:$") & after.rlike("^@"),
        "block": value.rlike("^-----BEGIN"),
    }
    return [F.coalesce(found[f].cast("double"), F.lit(0.0)).alias(f) for f in FEATURES]


def feature_struct(value: Column, before: Column, after: Column, path: Column, language: Language, odds: dict[str, float]) -> Column:
    """The features of one candidate as a struct of doubles, never null."""
    return F.struct(*_features(value, before, after, path, language, odds))


def derived_findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", rows: int = 800) -> DataFrame:
    """Labelled findings (value, before, after, path, label), made from about `rows` documents picked by a hash.

    Stands in for findings labelled by hand, which the tables don't hold. A value is a secret where it is random: bits of a
    digest in one of six alphabets, of 10 to 64 characters, in any of twelve settings, bare in prose among them. It is none
    where it is made of a document's own words or numbers, is a placeholder, a date, an address's path, or a digest that is
    named as such. Alphabet, length, setting and words are drawn by independent hashes, so no form stands for a label.
    """
    part = min(1.0, rows / max(docs.count(), 1))
    base = docs.where(F.pmod(F.xxhash64(id_col, F.lit(11)), F.lit(1 << 20)) < int(part * (1 << 20)) + 1).limit(2 * rows + 100)
    w = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}]+"), lambda x: F.length(x) > 1)
    base = base.select(F.coalesce(F.col(id_col).cast("string"), F.lit("0")).alias("i"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("p"), w.alias("w")).withColumn("w", F.when(F.size("w") > 0, F.transform(F.sequence(F.lit(0), F.lit(63)), lambda j: F.get("w", F.pmod(F.xxhash64("i", j), F.size("w")).cast("int"))))).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5))))
    draw = lambda salt, n: F.pmod(F.xxhash64("i", "k", F.lit(salt)), F.lit(n)).cast("int")
    pick = lambda salt, *of: F.get(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in of]), draw(salt, len(of)))
    word = lambda salt: F.coalesce(F.get("w", F.pmod(F.xxhash64("i", "k", F.lit(salt)), F.lit(64)).cast("int")), F.lit("word"))
    base = base.withColumn("raw", F.concat(F.sha2(F.concat("i", F.lit("/"), F.col("k").cast("string")).cast("binary"), 512), F.sha2(F.concat(F.col("k").cast("string"), F.lit("/"), F.col("i")).cast("binary"), 512))).withColumns({"b64": F.base64(F.unhex("raw")), "number": F.translate("raw", "abcdef", "173950")}).withColumn("plain", F.regexp_replace("b64", "[+/=]", ""))
    raw, b64, plain, number = (F.col(c) for c in ("raw", "b64", "plain", "number"))
    length = 10 + draw("length", 55)
    cut_to = lambda v: F.substring(v, 1, length)
    random = pick("alphabet", cut_to(raw), F.upper(cut_to(raw)), cut_to(plain), F.upper(cut_to(plain)), cut_to(b64), cut_to(F.translate(b64, "AaEeIiOo+/", "!$#%^*-_~.")))
    random = F.concat(pick("prefix", "", "", "", F.concat(F.substring(F.upper(plain), 100, 4), F.lit("")), F.concat(F.lower(F.substring(F.regexp_replace(plain, "[0-9]", ""), 90, 2)), F.lit("_"))), random)
    digits = lambda n: F.substring(number, 1, n)
    ordinary = pick(
        "kind",
        digits(16), digits(19), F.concat_ws("-", word("a"), word("b"), word("c"), digits(4)), F.concat_ws("/", word("a"), word("b"), digits(2), word("c")), F.concat_ws("_", word("a"), word("b"), word("c")), F.concat(word("a"), word("b")),
        F.concat_ws("_", F.lit("your"), word("a"), pick("ask", "token", "key", "secret"), F.lit("here")), F.concat(F.lit("example"), word("a"), digits(4)), F.concat(F.lit("changeme"), digits(3)), F.repeat(F.substring(raw, 1, 1), 10 + draw("times", 20)),
        F.concat(F.initcap(word("a")), F.initcap(word("b")), F.initcap(word("c")), digits(2)), F.concat(F.lit("20"), digits(2), F.lit("-10-1"), F.substring(number, 9, 1), F.lit("T10-0"), F.substring(number, 7, 1)), F.concat(word("a"), F.lit("."), word("b"), F.lit("()")),
    )
    prose = F.concat(word("x"), F.lit(" "), word("y"), F.lit(" "))
    asks = pick("asks", "password", "Password", "passwd", "pwd", "secret", "client_secret", "token", "TOKEN", "auth_token", "api_key", "apiKey", "API-KEY", "access_key", "credential", "private_key")
    names = pick("names", "name", "title", "file", "path", "color", "label", "author", "format")
    denies = pick("denies", "commit ", "sha256: ", "md5 ", "checksum = ", "digest: ", "etag: \"", "revision ", "order number ", "invoice ", "isbn ", "version ")
    quoted = lambda who, gap: F.struct(F.concat(prose, who, F.lit(gap + '"')).alias("before"), F.lit('" ').alias("after"))
    open_ = lambda who, gap, end=" ": F.struct(F.concat(prose, who, F.lit(gap)).alias("before"), F.lit(end).alias("after"))
    bare = F.struct(prose.alias("before"), pick("end", " ", ", ", ".", "\n", "").alias("after"))
    asked = [quoted(asks, "="), quoted(asks, " = "), quoted(asks, ":\t"), open_(asks, "="), open_(asks, ": "), open_(asks, " =  "), open_(F.lit("Authorization: Bearer"), " ", "\n")]
    address = F.struct(F.concat(prose, F.lit("https://"), word("u"), F.lit(":")).alias("before"), F.concat(F.lit("@"), word("h"), F.lit(".net")).alias("after"))
    secret = F.struct(random.alias("value"), pick("setting", *asked, address, bare, bare, bare, quoted(names, "=")).alias("at"), F.lit(1).alias("label"))
    other = F.struct(ordinary.alias("value"), pick("setting", *asked[:6], address, bare, bare, bare, quoted(names, "="), open_(names, ": ")).alias("at"), F.lit(0).alias("label"))
    named = F.struct(pick("digest", F.substring(raw, 1, 40), F.substring(raw, 1, 64), F.substring(raw, 1, 32)).alias("value"), F.struct(F.concat(prose, denies).alias("before"), F.lit(" ").alias("after")).alias("at"), F.lit(0).alias("label"))
    key = F.struct(F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), F.regexp_replace(b64, "[0-9]", "k"), F.lit("\n-----END RSA PRIVATE KEY-----")).alias("value"), bare.alias("at"), F.lit(1).alias("label"))
    made = base.select("p", F.explode(F.array(secret, secret, other, pick("rest", named, named, named, key))).alias("x"))
    return made.select("x.value", "x.at.before", "x.at.after", F.col("p").alias("path"), "x.label").distinct()


@dataclass
class Forest:
    """A trained forest as one SQL expression over an array x of FEATURES, and what its features were learned from."""

    sql: str
    trees: int
    language: Language
    odds: dict[str, float]

    def features(self, value: Column, before: Column, after: Column, path: Column) -> Column:
        return F.array(*_features(value, before, after, path, self.language, self.odds))


def train(findings: DataFrame, language: Language, trees: int = 24, depth: int = 8, seed: int = 7, max_rows: int = 40_000) -> Forest:
    """Fit a random forest to labelled findings (value, before, after, path, label); at most max_rows of them.

    With no findings, or with one label only, every candidate gets that label, or 1. What neighbouring words say is learned
    from a half of the findings, at most 200 words, and the forest from the other half, so it doesn't overrate them. Findings and
    features are written once, as the fit plans its input many times over and the driver holds each plan.
    """
    rows = cut(findings.where("value is not null and label is not null").select("value", F.coalesce("before", F.lit("")).alias("before"), F.coalesce("after", F.lit("")).alias("after"), "path", F.col("label").cast("double").alias("label")).limit(max_rows))
    kinds = [r[0] for r in rows.select("label").distinct().limit(3).collect()]
    if len(kinds) < 2:
        drop(rows)
        return Forest(f"{kinds[0] if kinds else 1.0}D", 0, language, {})
    half = F.pmod(F.xxhash64("value", "before"), F.lit(2)) == 0
    near = rows.where(half).select("label", F.explode(F.array_distinct(_words_before(F.col("before")))).alias("w")).groupBy("w").agg(F.sum("label").alias("y"), F.count("*").alias("n")).where("n >= 20").orderBy(F.desc("n"), "w").limit(200).collect()
    odds = {r["w"]: round(math.log((r["y"] + 1) / (r["n"] - r["y"] + 1)), 3) for r in near}
    key = ["value", "before", "after"]
    known = cut(rows.where(~half).select(*key, "label", *_features(F.col("value"), F.col("before"), F.col("after"), F.col("path"), language, odds)))
    x = known.repartition(4, "value").sortWithinPartitions(*key).select(*FEATURES, "label").persist()
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=2).fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(x))

    nodes = []

    def grow(node) -> int:
        """The place of node in nodes (feature, threshold, left, right, value); a leaf leads to itself."""
        at = len(nodes)
        nodes.append((0, 0.0, at, at, 0.0))
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            nodes[at] = (0, 0.0, at, at, f"{stats[1] / max(sum(stats), 1e-9):.6f}")
        else:
            split = node.split()
            nodes[at] = (split.featureIndex(), split.threshold(), grow(node.leftChild()), grow(node.rightChild()), 0.0)
        return at

    tops = [grow(t._java_obj.rootNode()) for t in model.trees]
    x.unpersist()
    drop(known)
    drop(rows)
    held = lambda values, kind: f"cast(split('{' '.join(map(str, values))}', ' ') AS array<{kind}>)"
    feature, threshold, left, right, value = (held(column, kind) for column, kind in zip(zip(*nodes, strict=True), ("int", "double", "int", "int", "double"), strict=True))
    step = f"if(get(x, get({feature}, n)) <= get({threshold}, n), get({left}, n), get({right}, n))"
    leaf = f"aggregate(sequence(1, {depth}), top, (n, k) -> {step})"
    return Forest(f"aggregate({held(tops, 'int')}, 0.0D, (acc, top) -> acc + get({value}, {leaf})) / {len(tops)}.0D", len(tops), language, odds)


def train_from(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> Forest:
    """train() on derived_findings of docs and the language of docs."""
    return train(derived_findings(docs, id_col, text_col, path_col), learn_language(docs, id_col, text_col))


def _scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """rows (doc_id, text, path, more) with pieces between candidates, the candidates and their scores."""
    cut_ = rows.withColumn("__m", F.coalesce(F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)), F.array().cast("array<string>"))).withColumn("__s", F.when(F.size("__m") > 0, F.split("text", CANDIDATE, -1)))
    features = cut_.withColumn("__x", F.transform("__m", lambda v, i: forest.features(v, F.right(F.get(F.col("__s"), i), F.lit(48)), F.left(F.get(F.col("__s"), i + 1), F.lit(24)), F.col("path"))))
    return features.withColumn("__p", F.expr(f"transform(__x, x -> {forest.sql})"))


def _rows(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (F.col(path_col) if path_col else F.lit(None)).cast("string").alias("path"))


def scan(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, start and length in characters, value, score, is_secret.

    Null and empty texts have no candidates; repeated rows each give theirs; a null doc_id stays null.
    """
    s = _scored(_rows(docs, id_col, text_col, path_col), forest).where(F.size("__m") > 0)
    lengths = lambda col, n: F.aggregate(F.slice(col, 1, n), F.lit(0), lambda a, v: a + F.length(v))
    found = s.select("doc_id", F.explode(F.transform("__m", lambda v, i: F.struct((lengths(F.col("__s"), i + 1) + lengths(F.col("__m"), i)).alias("start"), F.length(v).alias("length"), v.alias("value"), F.get(F.col("__p"), i).alias("score")))).alias("f"))
    return found.select("doc_id", "f.*").withColumn("is_secret", F.col("score") >= threshold)


def mask(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = 0.5, chars_col: str | None = "n_chars") -> DataFrame:
    """docs with every secret in text_col replaced by MASK; chars_col, if it exists, is the new length of changed texts.

    All rows and columns stay; null texts stay null. A projection: nothing is shuffled.
    """
    names = docs.columns
    held = docs.select(F.struct(*names).alias("__row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (F.col(path_col) if path_col else F.lit(None)).cast("string").alias("path"))
    s = _scored(held, forest)
    secret = F.exists("__p", lambda p: p >= threshold)
    joined = F.concat(F.array_join(F.transform("__m", lambda v, i: F.concat(F.get(F.col("__s"), i), F.when(F.get(F.col("__p"), i) >= threshold, F.lit(MASK)).otherwise(v))), ""), F.element_at("__s", -1))
    s = s.withColumn("__text", F.when(secret, joined).otherwise(F.col("text")))
    new = {text_col: F.col("__text")}
    if chars_col in names:
        kind = dict(docs.dtypes)[chars_col]
        new[chars_col] = F.when(secret, F.length("__text").cast(kind)).otherwise(F.col("__row")[chars_col])
    return s.select(*[new[c].alias(c) if c in new else F.col("__row")[c].alias(c) for c in names])

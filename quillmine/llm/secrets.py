"""Secret scanning: patterns propose candidates and a random forest removes the false positives.

Candidates, their features, the forest's votes and the masked text are all expressions over one row,
so a scan reads each text once and shuffles nothing.  What ordinary words look like, that is which are
frequent and which letters follow each other, is counted over all texts; how telling a neighbouring
word is, over labelled findings.  The forest is trained with the DataFrame API of Spark ML on those
findings and then written out as expressions.
"""

from __future__ import annotations

from functools import reduce
from math import log
from typing import NamedTuple

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmine.llm.common import pick, settle

NAMES = r"(?:password|passwd|pwd|passphrase|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|bearer|authorization)"
LED = rf"(?i:{NAMES})[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?(?:(?i:bearer|basic)\s{{1,3}}(?=[^\s\"',;]{{6}}))?"
ASSIGNED = rf"(?=[pPsStTcCaAbB]){LED}[^\s\"',;]{{6,}}"
# A key's body: lines of Base64, or else what stands before an END line, however long.  Possessive repeats
# need no stack.
LINES = r"(?:\s*+[A-Za-z][A-Za-z-]*+: [^\r\n]*+)*+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{40,}+)++(?:(?:\s|\\[nr])++=?+[A-Za-z0-9+/]*+={0,2}+(?=[\r\n\\]|$)){0,2}+"
LAST = r"-----END [A-Z0-9 ]*+-----"
PEM = rf"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?:{LINES}(?:\s|\\[nr])*+{LAST}|(?s:(?!-----(?:BEGIN|END) ).)*+{LAST}|{LINES})?"
# Runs with a digit, and long ones without.
RUN = r"(?<![A-Za-z0-9_+/.~-])(?:(?=[A-Za-z_+/.~-]*[0-9])[A-Za-z0-9_+/.~-]{12,}|(?=[_+/.~-]*[A-Za-z])[A-Za-z_+/.~-]{20,})"
CANDIDATE = f"{PEM}|{ASSIGNED}|{RUN}"
NEEDED = "[0-9:=]|-----BEGIN|[A-Za-z_+/.~-]{20}"  # what every candidate holds: a digit, a sign of assignment, a key's first line or a long run
KNOWN = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}$|^(sk|rk|pk)_(live|test)_[0-9A-Za-z]{16,}$|^xox[baprs]-[0-9A-Za-z-]{10,}$|^AIza[0-9A-Za-z_-]{30,}$|^eyJ[A-Za-z0-9_-]+\.eyJ|^-----BEGIN "
# Words that are no secrets though the texts may have few of them, for the share of a candidate that a dictionary covers.
DICTIONARY = ["password", "passwd", "secret", "token", "changeme", "example", "sample", "dummy", "test", "placeholder", "default", "your", "admin", "user", "name", "login", "config", "version", "index", "page", "file", "image", "photo", "icon", "video", "data", "table", "column", "value", "string", "number", "null", "none", "true", "false", "http", "https", "www", "mail", "host", "local", "server", "client", "service", "system", "library", "package", "module", "class", "method", "function", "object", "release", "build", "branch", "commit", "master", "main", "src", "lib", "bin", "usr", "home", "etc", "var", "tmp", "docs", "html", "json", "yaml", "python", "java", "com", "org", "net", "the", "and", "for", "with", "from", "this", "that", "key", "api", "dev", "prod", "stage"]
FEATURES = ["length", "digits", "upper", "lower", "hex", "switches", "syllables", "distinct", "covered", "slashes", "dots", "shape", "path", "known", "assigned", "named_before", "hash_before", "harmless_near", "joined", "transitions", "usual_words", "neighbours"]
CONTEXT = 40
MASK = "[SECRET]"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BLOCK = 128  # candidates whose lengths are added up at a time


class Usage(NamedTuple):
    """What ordinary text looks like: its frequent words, and the log-odds of letters that follow each other
    against all being equally likely, by 27 * the first + the second (a is 1, z 26, anything else 0)."""

    words: list[str]
    transitions: list[float]


class Scanner(NamedTuple):
    """A forest with what its features need.  A tree is (feature, threshold, left, right) or a leaf's share of secrets."""

    forest: list
    usage: Usage
    neighbours: dict[str, float]


def _numbers(values: list, kind: str) -> Column:
    """An array literal; written as one string, since a literal for each would make plans of thousands of nodes."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def usage(documents: DataFrame, text_col: str = "text", most: int = 2000) -> Usage:
    """Counted over all words of all whole texts; the ``most`` frequent words and 26 * 26 counts reach the driver."""
    words = F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), "[^a-z]+")
    counts = pick(documents, text=text_col).select(F.explode(words).alias("word")).where(F.length("word").between(3, 24)).groupBy("word").agg(F.count("*").alias("n"))
    counts = settle(counts, "secret-words")
    frequent = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(most).collect()]
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))
    seen = {r.pair: r.n for r in counts.select("n", F.explode(pairs).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    odds = [0.0] * (27 * 27)
    for i, a in enumerate(LETTERS, 1):
        whole = sum(seen.get(a + b, 0) for b in LETTERS) + 26
        for j, b in enumerate(LETTERS, 1):
            odds[27 * i + j] = log((seen.get(a + b, 0) + 1) / whole * 26)
    return Usage(frequent, odds)


def neighbours(findings: DataFrame, most: int = 256) -> dict[str, float]:
    """The log-odds of secrets for words that stand before or after the findings, for the ``most`` frequent such words."""
    text = lambda n: F.coalesce(F.col(n), F.lit(""))
    rows = findings.where("label is not null").select("label", F.explode(F.array_distinct(_words_near(text("before"), text("after")))).alias("word"))
    counts = rows.groupBy("word").agg(F.sum((F.col("label") == 1).cast("int")).alias("yes"), F.sum((F.col("label") != 1).cast("int")).alias("no"))
    whole = findings.agg(F.coalesce(F.sum((F.col("label") == 1).cast("int")), F.lit(0)), F.coalesce(F.sum((F.col("label") != 1).cast("int")), F.lit(0))).first()
    got = counts.orderBy(F.desc(F.col("yes") + F.col("no")), "word").limit(most).collect()
    return {r.word: log((r.yes + 1) / (whole[0] + 2)) - log((r.no + 1) / (whole[1] + 2)) for r in got}


def _words_near(before: Column, after: Column) -> Column:
    """The last three words before and the first two after, lower-cased."""
    cut = lambda x: F.array_remove(F.split(F.lower(x), "[^a-z]+"), "")
    ahead = cut(before)
    return F.concat(F.slice(ahead, F.greatest(F.size(ahead) - 2, F.lit(1)), 3), F.slice(cut(after), 1, 2))


def _features(value: Column, kind: Column, before: Column, after: Column, known: Usage, near_odds: dict[str, float]) -> list[Column]:
    """Numbers about a candidate: its length, character transitions, dictionary coverage, path and neighbours."""
    size = F.greatest(F.char_length(value), F.lit(1))
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / size
    low, near = F.lower(value), F.lower(F.concat(before, F.lit(" "), after))
    near_own = F.concat(near, F.lit(" "), low)
    uncovered = F.char_length(F.regexp_replace(low, "(" + "|".join(sorted(DICTIONARY, key=len, reverse=True)) + ")", ""))
    number = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    codes = F.transform(F.filter(F.split(low, ""), lambda c: c != ""), lambda c: F.instr(F.lit(LETTERS), c))
    odds = _numbers(known.transitions, "double")
    follow = lambda x: F.zip_with(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))), lambda a, b: F.get(odds, a * 27 + b))
    transitions = F.aggregate(follow(codes), F.lit(0.0), lambda a, x: a + x) / size
    parts = F.regexp_extract_all(value, F.lit("[A-Z]?[a-z]+|[A-Z]+"), F.lit(0))
    # The words that begin with each letter, spaces around each.
    by_letter = F.split(F.lit(",".join(" " + " ".join(w for w in known.words if w[0] == x) + " " for x in LETTERS)), ",")
    is_usual = lambda w: F.coalesce(F.get(by_letter, F.instr(F.lit(LETTERS), F.left(w, F.lit(1))) - 1).contains(F.concat(F.lit(" "), w, F.lit(" "))), F.lit(False))
    usual = F.aggregate(F.filter(parts, lambda w: is_usual(F.lower(w))), F.lit(0), lambda a, w: a + F.char_length(w)) / size
    listed = F.str_to_map(F.lit(",".join(f"{w}:{n!r}" for w, n in (near_odds or {"-": 0.0}).items())), F.lit(","), F.lit(":"))
    around = F.aggregate(_words_near(before, after), F.lit(0.0), lambda a, w: a + F.coalesce(F.try_element_at(listed, w).cast("double"), F.lit(0.0)))
    return [
        F.log2(size.cast("double")), share("[0-9]"), share("[A-Z]"), share("[a-z]"), share("[0-9a-fA-F]"),
        share("(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]"), share("[bcdfghjklmnpqrstvwxyz][aeiou]"),
        F.size(F.array_distinct(F.split(value, ""))) / F.least(size, F.lit(64)), 1 - uncovered / size, share("/"), share("[.]"),
        number(value.rlike(r"^\+?[0-9().~ -]+$|^[0-9]+([.][0-9]+)+$|^[0-9]{4}-?[01][0-9]-?[0-3][0-9]|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")),
        number(value.rlike(r"^[./~]*([A-Za-z0-9_~+-]+/)+|[.][a-z]{2,5}$|^[A-Za-z0-9-]+([.][A-Za-z0-9-]+)*[.][a-z]{2,6}")),
        number(value.rlike(KNOWN)), number(kind == "assigned"), number(F.lower(before).rlike(NAMES + r"[\"']?\s*[:=]?\s*[\"']?$")),
        number(F.lower(before).rlike(r"(commit|sha-?[0-9]*|md5|hash|checksum|digest|etag|uuid|guid|id|isbn|issn|doi|order|phone|card|version|rev|build)[\"'# :=]*$")),
        number(near_own.rlike("example|sample|dummy|placeholder|changeme|your[-_]|x{6}|[*]{4}|[.]{3}|<[a-z]+>|test")),
        number(F.substring(before, -1, 1).rlike("[@/:#&?%]") | F.substring(after, 1, 1).rlike("[@/:#&?%(]")),
        transitions, usual, around,
    ]


def labelled_findings(spark: SparkSession, each: int = 120, words: list[str] | None = None) -> DataFrame:
    """(before, value, kind, after, label): findings of known truth, ``each`` of every sort below, written by
    rule from hashes, so that they are the same on every machine.  Those that consist of words take them
    from ``DICTIONARY`` and from ``words``, such as those of ``usage``."""
    ordinary = DICTIONARY + [w for w in words or [] if w.isalpha()]
    n = len(_sorts(F.lit(0), F.lit(0), ordinary))
    rows = spark.range(n * each, numPartitions=4).select((F.col("id") % n).cast("int").alias("sort"), F.floor(F.col("id") / n).cast("int").alias("nth"))

    def one(r: Column) -> Column:
        made = _sorts(r["sort"], r["nth"], ordinary)
        choose = lambda k: F.coalesce(*[F.when(r["sort"] == i, m[k] if isinstance(m[k], Column) else F.lit(m[k])) for i, m in enumerate(made)])
        return F.struct(*[choose(k).alias(name) for k, name in enumerate(("before", "value", "kind", "after", "label"))])

    # Within a function of arrays, as in a scan, since the choice is too large for one generated method.
    return settle(rows.select(F.inline(F.transform(F.array(F.struct("sort", "nth")), one))), "findings")


def _sorts(sort: Column, nth: Column, ordinary: list[str]) -> list[tuple]:
    """The (before, value, kind, after, label) of each sort."""
    h = lambda salt: F.sha2(F.concat_ws("-", sort.cast("string"), nth.cast("string"), F.lit(salt)), 256)
    hexa = lambda a, n: F.substring(h(a), 1, n)
    b64 = F.regexp_replace(F.base64(F.unhex(h("b"))), "[=\\s]", "")
    upper = F.translate(F.substring(F.upper(F.regexp_replace(F.base64(F.unhex(h("c"))), "[^A-Za-z0-9]", "7")), 1, 16), "", "")
    digits = F.substring(F.regexp_replace(h("d"), "[a-f]", "4"), 1, 16)
    word = lambda a: F.element_at(F.split(F.lit(" ".join(ordinary)), " "), (F.conv(hexa(a, 6), 16, 10).cast("int") % len(ordinary) + 1))
    plain = F.element_at(F.array(*map(F.lit, ["and then ", "see also ", "the following, ", "tion of the ", "en el ", "dans les ", ""])), nth % 7 + 1)
    tail = F.element_at(F.array(*map(F.lit, [" and more", ".", ", which", "\n", " der", '" '])), nth % 6 + 1)
    letters = lambda a, n: F.substring(F.regexp_replace(F.base64(F.unhex(F.concat(h(a), h(a + "2")))), "[^A-Za-z]", ""), 1, n)
    name = F.element_at(F.array(*map(F.lit, ["password=", 'token = "', "api_key: ", "secret = '", "Authorization: "])), nth % 5 + 1)
    free = lambda value, label: (plain, value, F.lit("free"), tail, label)
    given = lambda value, label: (F.concat(plain, name), value, F.lit("assigned"), tail, label)
    after = lambda text, value, label: (F.concat(plain, F.lit(text)), value, F.lit("free"), tail, label)
    make = [
        free(F.concat(F.lit("AKIA"), upper), 1), free(F.concat(F.lit("ghp_"), F.substring(F.concat(hexa("a", 30), b64), 1, 36)), 1), free(F.concat(F.lit("sk_live_"), F.translate(F.substring(b64, 1, 24), "+/", "ab")), 1),
        given(hexa("a", 18), 1), given(hexa("a", 40), 1), given(F.substring(b64, 1, 32), 1), given(F.concat(F.substring(b64, 1, 7), F.lit("!"), F.substring(b64, 9, 5)), 1), given(F.concat(F.lit("AKIA"), upper), 1), given(F.substring(b64, 1, 12), 1),
        (plain, F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), b64), F.lit("pem"), tail, 1), (plain, F.concat(F.lit("-----BEGIN OPENSSH PRIVATE KEY-----\n"), F.repeat(F.concat(word("e"), F.lit(" "), word("f"), F.lit("\n"), word("g"), F.lit(", 1\n")), F.pow(F.lit(3), nth % 8).cast("int")), F.lit("-----END OPENSSH PRIVATE KEY-----")), F.lit("pem"), tail, 1), free(F.concat(F.lit("xoxb-"), digits, F.lit("-"), F.substring(b64, 1, 20)), 1),
        free(letters("a", 32), 1), free(F.lower(letters("a", 40)), 1), given(letters("a", 24), 1), after("the key is ", letters("b", 28), 1), after("use ", hexa("a", 32), 1), free(F.substring(b64, 1, 40), 1),
        free(F.concat(word("e"), word("f"), word("g"), word("h"), word("i"), word("j")), 0), free(F.concat(F.initcap(word("e")), F.initcap(word("f")), F.initcap(word("g")), F.initcap(word("h")), F.initcap(word("i"))), 0),
        free(F.concat(word("e"), F.lit("_"), word("f"), F.lit("_"), word("g"), F.lit("_"), word("h"), F.lit("_"), word("i")), 0), free(F.concat(F.lit("/"), word("e"), F.lit("/"), word("f"), F.lit("/"), word("g"), F.lit("/"), word("h"), F.lit("/"), word("i")), 0),
        free(digits, 0), free(F.concat(F.substring(digits, 1, 3), F.lit("."), F.substring(digits, 4, 3), F.lit("."), F.substring(digits, 7, 3), F.lit("."), F.substring(digits, 10, 3)), 0),
        after("someone@", F.concat(word("e"), F.substring(digits, 1, 1), F.lit(".example.com"), F.lit("")), 0), after("https://", F.concat(word("e"), F.lit(".org/"), word("f"), F.lit("/"), F.substring(digits, 1, 4), F.lit(".html")), 0),
        free(F.concat(F.lit("/usr/lib/"), word("e"), F.lit("/"), word("f"), F.lit("-"), F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 1)), 0), after("commit ", hexa("a", 40), 0), after("sha256: ", hexa("a", 64), 0), after("md5 ", hexa("a", 32), 0),
        after("id ", F.concat(hexa("a", 8), F.lit("-"), hexa("b", 4), F.lit("-"), hexa("c", 4), F.lit("-"), hexa("d", 4), F.lit("-"), hexa("e", 12)), 0), free(F.concat(F.lit("2024-0"), F.substring(digits, 1, 1), F.lit("-12T10:"), F.substring(digits, 2, 2)), 0),
        given(F.lit("changeme"), 0), given(F.concat(F.lit("your-"), word("e"), F.lit("-here")), 0), given(F.lit("xxxxxxxxxxxx"), 0), given(F.concat(F.lit("example"), F.substring(digits, 1, 3)), 0), given(F.concat(word("e"), word("f"), F.lit(".")), 0), given(F.concat(F.lit("os.environ["), word("e")), 0), given(F.concat(F.lit("<"), word("e"), F.lit(">")), 0),
        free(F.concat(word("e"), word("f"), word("g"), F.substring(digits, 1, 2)), 0), free(F.concat(word("e"), F.lit("_"), word("f"), F.lit("_"), F.substring(digits, 1, 2)), 0), free(F.concat(word("e"), F.lit("-v"), F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 1), F.lit("."), F.substring(digits, 3, 2)), 0),
        free(F.concat(F.lit("+1-"), F.substring(digits, 1, 3), F.lit("-"), F.substring(digits, 4, 3), F.lit("-"), F.substring(digits, 7, 4)), 0), after("10.1016/", F.concat(F.lit("j."), word("e"), F.lit(".2019."), F.substring(digits, 1, 6)), 0),
    ]
    return make


def train(findings: DataFrame, known: Usage, trees: int = 30, depth: int = 6, seed: int = 5) -> Scanner:
    """A random forest of findings ``(before, value, kind, after, label)``: trees of (feature, threshold, left, right) or a leaf's share of secrets.

    Nulls among the texts count as empty; findings without a label aren't used.  Of one label only, the
    forest is one leaf of that label; of none, of 0."""
    names = ("value", "kind", "before", "after")
    near, given = neighbours(findings), F.struct(*[F.coalesce(F.col(n), F.lit("")).alias(n) for n in names])
    # Within a function of arrays, as in a scan, since they are too many for one generated method.
    values = F.transform(F.array(given), lambda x: F.struct(*[v.cast("double").alias(n) for n, v in zip(FEATURES, _features(*[x[n] for n in names], known, near), strict=True)]))
    table = settle(findings.where("label is not null").select(F.col("label").cast("double").alias("label"), F.inline(values)), "finding-features")
    kinds = table.agg(F.count("*"), F.min("label"), F.max("label")).first()
    if not kinds[0] or kinds[1] == kinds[2]:  # nothing to tell apart
        return Scanner([kinds[1] or 0.0], known, near)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table)
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(ready)

    def walk(node):
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            return (stats[1] if len(stats) > 1 else 0.0) / (sum(stats) or 1.0)
        split = node.split()
        return split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return Scanner([walk(t._java_obj.rootNode()) for t in model.trees], known, near)


def _votes(forest: list, x: Column) -> Column:
    """The mean of the trees' leaves for the array of features ``x``.

    The nodes of all trees stand in arrays, and a tree is gone down by a fold over its depth; a leaf leads
    to itself."""
    feature, threshold, left, right, roots, deep = [], [], [], [], [], 1

    def add(node, depth: int) -> int:
        nonlocal deep
        at, deep = len(feature), max(deep, depth)
        feature.append(0)
        threshold.append(float(node) if not isinstance(node, tuple) else node[1])
        left.append(at)
        right.append(at)
        if isinstance(node, tuple):
            feature[at] = node[0]
            left[at], right[at] = add(node[2], depth + 1), add(node[3], depth + 1)
        return at

    for tree in forest:
        roots.append(add(tree, 0))
    f, t, lo, hi = _numbers(feature, "int"), _numbers(threshold, "double"), _numbers(left, "int"), _numbers(right, "int")
    down = lambda node: F.when(F.get(x, F.get(f, node)) <= F.get(t, node), F.get(lo, node)).otherwise(F.get(hi, node))
    leaf = lambda root: F.get(t, F.aggregate(F.sequence(F.lit(1), F.lit(deep)), root, lambda node, _: down(node)))
    return F.aggregate(_numbers(roots, "int"), F.lit(0.0), lambda a, root: a + leaf(root)) / float(len(roots))


def scan(documents: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, findings, masked): one row for each row of the input.

    findings is an array of (start, length, kind, score, secret), in order: where a candidate's value
    stands (from 1, in characters), which pattern proposed it, the forest's score and whether that
    reaches ``threshold``.  masked is the text with each secret's value replaced; a text without
    candidates is as it was, null remains null and has no findings.  Rows are judged one by one, so
    repeated rows, ties and empty tables need no more to be said.  Texts are searched whole, and the
    time grows with their length, however many candidates they hold.
    """
    return _scanned(pick(documents, id=id_col, text=text_col), "text", scanner, threshold).select("id", F.col("__findings").alias("findings"), F.col("__masked").alias("masked"))


def mask(documents: DataFrame, scanner: Scanner, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """All rows and columns as they are, but for the values of secrets in the text."""
    names = documents.columns
    at = names.index(text_col)
    rows = documents.toDF(*[f"_{i}" for i in range(len(names))])
    rows = _scanned(rows, f"_{at}", scanner, threshold)
    return rows.select(*[F.col("__masked" if i == at else f"_{i}").alias(n) for i, n in enumerate(names)])


def _scanned(rows: DataFrame, text_col: str, scanner: Scanner, threshold: float) -> DataFrame:
    """The rows with __findings and __masked."""
    text = F.col(text_col)
    none = F.array().cast("array<string>")
    cut = lambda group: F.when(F.col("__hit"), F.regexp_extract_all(text, F.lit(rf"(?s)\G(.*?)({CANDIDATE})"), F.lit(group))).otherwise(none)
    # What is used more than once stays a column of its own; the optimizer would put it where it is used,
    # into functions of single candidates even, and have texts searched again for each.
    rows = rows.withColumn("__hit", F.coalesce(text.rlike(NEEDED) & text.rlike(CANDIDATE), F.lit(False))).withColumn("__cut", F.struct(cut(1).alias("gaps"), cut(2).alias("matches")))
    found = F.col("__hit")
    kind = lambda m: F.when(m.startswith("-----BEGIN"), "pem").when(m.rlike(rf"^{ASSIGNED}$"), "assigned").otherwise("free")
    value = lambda m: F.when(kind(m) == "assigned", F.regexp_replace(m, f"^{LED}", "")).otherwise(m)
    lengths = F.transform(F.arrays_zip(F.col("__cut.gaps").alias("g"), F.col("__cut.matches").alias("m")), lambda x: F.char_length(x["g"]) + F.char_length(x["m"]))
    rows = rows.withColumn("__len", lengths)
    total = lambda numbers: F.aggregate(numbers, F.lit(0), lambda a, n: a + n)
    used = total(F.col("__len"))
    tail = F.when(found, text.substr(used + 1, F.char_length(text))).otherwise(text)
    rows = rows.withColumn("__cut", F.struct("__cut.gaps", "__cut.matches", tail.alias("tail")))
    gaps, matches, tail = F.col("__cut.gaps"), F.col("__cut.matches"), F.col("__cut.tail")

    def one(gap: Column, at: Column) -> Column:
        match = F.element_at(matches, at + 1)
        held = value(match)
        led = F.substr(match, F.lit(1), F.char_length(match) - F.char_length(held))
        # No match has under 10 characters, so four of them with their gaps reach back far enough.
        first = F.greatest(at - 4, F.lit(0))
        last = lambda x: F.right(x, F.lit(CONTEXT))
        earlier = F.zip_with(F.slice(gaps, first + 1, at - first), F.slice(matches, first + 1, at - first), lambda g, m: F.concat(last(g), last(m)))
        before = F.concat(last(F.concat(F.array_join(earlier, ""), last(gap))), led)
        after = F.coalesce(F.try_element_at(gaps, at + 2), tail)
        return F.struct(gap.alias("gap"), led.alias("led"), held.alias("value"), kind(match).alias("kind"), before.alias("before"), F.left(after, F.lit(CONTEXT)).alias("after"))

    rows = rows.withColumn("__found", F.transform(gaps, one))
    featured = F.transform(F.col("__found"), lambda x: F.array(*[v.cast("double") for v in _features(x["value"], x["kind"], x["before"], x["after"], scanner.usage, scanner.neighbours)]))
    rows = rows.withColumn("__x", featured)
    rows = rows.withColumn("__score", F.transform("__x", lambda x: _votes(scanner.forest, x)))
    pieces = F.arrays_zip(F.col("__found").alias("f"), F.col("__score").alias("s"))
    # Where candidates begin: sums of the lengths before them, by blocks, since a growing array would be
    # copied for each.  Each column is named twice where it is used, for the reason above.
    upto = lambda x: F.when(F.size(x) > 0, F.sequence(F.lit(0), F.size(x) - 1)).otherwise(F.array().cast("array<int>"))
    blocks = F.when(F.size("__len") > 0, F.sequence(F.lit(0), F.floor((F.size("__len") - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("__sum", F.transform(blocks, lambda b: total(F.slice("__len", b * BLOCK + 1, F.lit(BLOCK)))))
    rows = rows.withColumn("__base", F.transform(upto(F.col("__sum")), lambda b: total(F.slice("__sum", F.lit(1), b))))

    def finding(x: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        before = F.element_at("__base", block + 1) + total(F.slice("__len", block * BLOCK + 1, i - block * BLOCK))
        start = before + F.char_length(x["f"]["gap"]) + F.char_length(x["f"]["led"]) + 1
        return F.struct(start.alias("start"), F.char_length(x["f"]["value"]).alias("length"), x["f"]["kind"].alias("kind"), x["s"].alias("score"), (x["s"] >= threshold).alias("secret"))

    none = F.array().cast("array<struct<start:int,length:int,kind:string,score:double,secret:boolean>>")
    rows = rows.withColumn("__findings", F.when(F.size("__base") > 0, F.transform(pieces, finding)).otherwise(none))
    masked = F.transform(pieces, lambda x: F.concat(x["f"]["gap"], x["f"]["led"], F.when(x["s"] >= threshold, F.lit(MASK)).otherwise(x["f"]["value"])))
    return rows.withColumn("__masked", F.when(found, F.concat(F.array_join(masked, ""), tail)).otherwise(text))


def scanner_of(documents: DataFrame, text_col: str = "text") -> Scanner:
    """A scanner that knows the documents' words, trained on ``labelled_findings``."""
    known = usage(documents, text_col)
    return train(labelled_findings(documents.sparkSession, words=known.words), known)


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    """One row a candidate: where it stands, its score and the verdict."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = scan(documents, scanner_of(documents))
    # Of inline() the optimizer infers a filter that would scan each text a second time.
    return out.select(F.col("id").alias("doc_id"), F.inline_outer("findings")).where("start is not null")

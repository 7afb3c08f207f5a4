"""Secret scans: candidates in texts, and a random forest that removes false positives.

A candidate is a run of 16 or more characters of base64, hex and identifiers that has a digit; any value after a credential
word with = or :; what follows a vendor's prefix; and the password of a connection URL. The forest looks at its length, character classes and transitions, dictionary coverage, the path it was found in and the neighbouring words. It
is trained on labelled findings; any table with the columns of labelled_findings() will do. DataFrame functions and
Spark's own DataFrame estimators only; a text passes through one projection without any shuffle.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.llm import common

#: The forest is trained on at most so many labelled findings.
LABELLED = 8192
TREES, DEPTH, SEED = 40, 8, 11
THRESHOLD = 0.5
_BREAK = r"[ \t\n\x0B\f\r]+"
_CANDIDATE = r"(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{16,}={0,2}"
#: A credential word with its sign, within a word or at the end of the words before; a value after it; a vendor's key; a
#: connection URL's user and password.
_NAMED = r"(?i:passw(?:or)?d|passphrase|pass|pwd|secret|token|key|auth|authorization|bearer|credentials?|private|access|login)[\"'\])]*"
_SIGN = r"(?::=|=>|==|[:=])"
_VALUE = r"[^\s\"'`<>]*[^\s\"'`<>,;.()\[\]{}]"
_ASSIGNED = rf"({_NAMED}{_SIGN}[\"'`(]*)({_VALUE})"
_SIGNED = rf"(?:{_NAMED} ?{_SIGN}|(?i:bearer|basic))[\"'`(]*$"
_VENDOR = r"(?<![A-Za-z0-9])((?:AKIA|ASIA|gh[pousr]_|github_pat_|sk-|sk_live_|xox[abp]-|AIza|glpat-|eyJ)[A-Za-z0-9+/_.\-]*[A-Za-z0-9+/_\-]={0,2})"
_URL = r"(://[^/\s:@]*:)([^@\s/]+)@"
#: Words that speak for and against a secret beside a candidate, of files that hold examples, and a dictionary.
_FOR = "pass|passwd|password|pwd|secret|token|key|apikey|auth|bearer|credential|private|access|login"
_AGAINST = "commit|sha1|sha256|md5|checksum|digest|hash|etag|uuid|guid|revision|card|phone|isbn|serial|version|build|order|invoice|example|sample|dummy"
_EXAMPLES = "test|example|sample|fixture|mock|demo|docs|spec|vendor|node_modules|lock"
#: Paths of labelled findings: of sources; of examples, vendored code, lock and generated files.
_PATHS = ["src/app.py", "src0", "conf/settings.ini", "web/page.html", "src12"]
_EXAMPLE_PATHS = [
    *["tests/app.py", "docs/usage.md", "examples/a.ini", "spec/fixtures/keys.json", "vendor/auth.go", "node_modules/a/b.js", "src/mock.py"],
    *["poetry.lock", "go.sum", "web/logo.svg", "static/app.min.js", "static/app.map", "analysis.ipynb"],
]
_AFTER = ["and the", "", "now", "# set it", "; end", "was here", "thereof"]
_EXAMPLE_AFTER = ["# example only", "(sample)", "dummy value", "// example key", "-- sample"]
_DICTIONARY = (
    "password|passwd|token|secret|example|sample|dummy|change|your|here|insert|test|user|name|admin|default|value|placeholder"
    "|config|version|release|build|index|file|image|data|number|service|client|server|the|and|for|with|that|this|from|have"
    "|about|which|their|would|there|could|other|after|first|project|module|package|function|class|object|string|ing|tion|ment"
)


def _share(text: Column, pattern: str) -> Column:
    """Share of text that pattern covers."""
    size = F.greatest(F.length(text), F.lit(1))
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))) / size


def features(rows: DataFrame) -> DataFrame:
    """rows (path, before, candidate, after) with the columns x_*, from which the forest judges."""
    c = F.col("candidate")
    size = F.greatest(F.length(c), F.lit(1))
    shape = c
    for pattern, mark in (("[0-9]+", "9"), ("[a-z]+", "a"), ("[A-Z]+", "A"), (r"[+/_\-=]+", ".")):
        shape = F.regexp_replace(shape, pattern, mark)
    runs = F.length(shape)
    near, after = F.lower(F.coalesce("before", F.lit(""))), F.lower(F.coalesce("after", F.lit("")))
    path = F.lower(F.coalesce("path", F.lit("")))
    columns = {
        "length": F.length(c),
        "digits": _share(c, "[0-9]"),
        "lower": _share(c, "[a-z]"),
        "upper": _share(c, "[A-Z]"),
        "marks": _share(c, r"[+/_\-=]"),
        "hex": c.rlike("^[0-9a-f]+$|^[0-9A-F]+$").cast("int"),
        "transitions": runs / size,
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / F.least(size, F.lit(32)),
        "repeats": _share(c, r"(.)\1{2,}"),
        "dictionary": _share(F.lower(c), _DICTIONARY),
        "vendor": c.rlike("^(AKIA|ASIA|ghp_|gho_|github_pat_|sk-|sk_live_|xox[abp]-|AIza|glpat-|eyJ)").cast("int"),
        "for": near.rlike(_FOR).cast("int"),
        "against": near.rlike(_AGAINST).cast("int") + after.rlike(_AGAINST).cast("int"),
        "url": near.rlike("://[^/ ]*:$").cast("int"),
        "assigned": near.rlike("[=:]\\s*[\"']?$").cast("int"),
        "example_path": path.rlike(_EXAMPLES).cast("int"),
        "lock_path": path.rlike(r"\.(lock|sum|svg|map|min\.js|ipynb)$").cast("int"),
    }
    return rows.withColumns({f"x_{name}": F.coalesce(value.cast("double"), F.lit(0.0)) for name, value in columns.items()})


def labelled_findings(spark: SparkSession, rows: int = LABELLED) -> DataFrame:
    """path, before, candidate, after, label (1: a secret): findings made from a rule, a third of them secrets.

    Secrets: vendor keys, hex and base64 strings, tokens of three parts, random letters, and passwords (also of plain words) beside words that name credentials, passwords of URLs. Others:
    plain words, numbers and variables beside such words, prefixes alone, checksums, commits, card
    and serial numbers, identifiers, placeholders, and the secrets' strings in files of examples, in vendored, lock and
    generated files, and where the next words call them an example.
    """
    df = spark.range(min(rows, LABELLED)).withColumn("h", F.sha2(F.concat(F.lit("finding-"), F.col("id").cast("string")), 512))
    word = F.conv(F.substring("h", 121, 4), 16, 10).cast("int")

    def pick(values: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.pmod(word, F.lit(len(values))) + 1)

    b64 = F.regexp_replace(F.base64(F.unhex(F.substring("h", 1, 96))), r"[+/=]", "x")
    upper = F.upper(F.translate(F.conv(F.substring("h", 1, 15), 16, 36), "0189", "QWZK"))
    long_hex = F.substring(F.col("h"), F.lit(1), F.pmod(word, F.lit(5)) * 6 + 16)
    names = pick(["passwordplaceholder", "your-token-goes-here", "example_config_value", "service-client-index", "this_is_the_default_name"])
    digits = F.rpad(F.conv(F.substring("h", 20, 13), 16, 10), 16, "7")
    uuid = F.concat_ws("-", *[F.substring("h", a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    text = pick(["the of and ", "in that was ", "value, then ", "on this. "])
    secret_word = F.concat(text, pick(["password=", "token = \"", "api_key: ", "secret=", "Authorization: Bearer ", "auth_token='"]))
    innocent = F.concat(text, pick(["commit ", "sha256:", "checksum ", "uuid=", "etag: ", "card ", "serial "]))
    aws = F.concat(F.lit("AKIA"), F.rpad(F.concat(upper, F.upper(F.substring("h", 40, 8))), 16, "J7X"))
    password = F.concat(pick(["Tr0ub", "drag0n", "Blue", "corr3ct", "q", "Z"]), F.substring(b64, 1, 5), pick(["", "!", "#1", "7"]), F.pmod(word, F.lit(90)).cast("string"))
    # Words that people make passwords of, and the sign right before, as in code and settings.
    people = ["hunter", "summer", "dragon", "monkey", "tiger", "horse", "battery", "staple", "correct", "winter", "sunny", "magic", "robot", "coffee", "guitar", "purple", "wizard", "rocket"]
    said = [F.element_at(F.array(*map(F.lit, people)), F.pmod(F.conv(F.substring("h", 101 + 4 * i, 3), 16, 10).cast("int"), F.lit(len(people))) + 1) for i in range(3)]
    assigned = F.concat(text, pick(["password=", "passwd=", "api_key=", "secret=", "pwd: ", "db_password = \""]))
    letters = F.translate(F.sha2(F.concat(F.lit("letters-"), F.col("id").cast("string")), 256), "0123456789", "ghijklmnop")
    cases = [
        (aws, text, 1),
        (aws, secret_word, 1),
        (long_hex, secret_word, 1),
        (F.substring("h", 1, 40), secret_word, 1),
        (F.substring(b64, 1, 40), secret_word, 1),
        (F.concat(pick(["ghp_", "sk-", "glpat-", "xoxb-"]), F.substring(b64, 1, 36)), text, 1),
        (F.substring("h", 30, 18), secret_word, 1),
        (F.substring(b64, 5, 24), secret_word, 1),
        (digits, text, 0),
        (digits, innocent, 0),
        (F.substring("h", 1, 40), innocent, 0),
        (F.substring("h", 1, 64), innocent, 0),
        (uuid, F.concat(text, pick(["", "id=", "uuid=", "request "])), 0),
        (F.concat(names, F.substring(F.col("id").cast("string"), 1, 2)), secret_word, 0),
        (F.concat(names, F.lit("-"), F.pmod(word, F.lit(100)).cast("string")), text, 0),
        (F.concat(pick(["xxxxxxxxxxxxxxx1", "0000000000000000", "1234567890123456", "aaaaaaaaaaaa1234"]), F.lit("0")), secret_word, 0),
        (password, secret_word, 1),
        (password, secret_word, 1),
        (F.concat(F.substring(b64, 1, 3), pick(["$", "!", "#", "%x"]), F.substring(b64, 9, 5), pick(["!", "&", ""])), secret_word, 1),
        (password, F.concat(text, pick(["postgres", "mysql", "amqp", "https"]), F.lit("://"), pick(["admin:", "user:", "app:"])), 1),
        (F.concat(F.lit("AKIA"), F.substring(F.translate(upper, "23456789", "BCDFGHJK"), 1, 9), F.translate(F.substring("h", 60, 7), "0123456789abcdef", "QRSTUVWXYZABCDEF")), text, 1),
        (pick(["it", "is", "the", "none", "null", "required", "string", "Bearer", "yes", "false", "optional", "about", "see"]), secret_word, 0),
        (pick(["changeme", "your_password", "getpass", "placeholder", "example", "which", "default", "value", "ment", "hidden", "words"]), secret_word, 0),
        (pick(["${TOKEN}", "$PASSWORD", "os.environ", "{{secret}}", "%s", "****", "xxxxxxxx", "self.token", "getenv(KEY"]), secret_word, 0),
        (F.pmod(word, F.lit(999)).cast("string"), secret_word, 0),
        (F.concat(said[0], F.pmod(word, F.lit(100)).cast("string"), said[1]), assigned, 1),
        (F.concat(said[1], said[0], said[2]), assigned, 1),
        (F.concat(F.substring(letters, 1, 20), F.lit("")), assigned, 1),
        (F.concat(F.lit("eyJ"), F.substring(b64, 1, 17), F.lit(".eyJ"), F.substring(b64, 20, 20), F.lit("."), F.substring(b64, 30, 30)), text, 1),
        (pick(["sk-learn", "sk-ip", "eyJ", "AIza", "sk-", "ASIA-pacific", "AKIA"]), text, 0),
    ]
    kind, place = F.pmod("id", F.lit(len(cases))), F.pmod(F.floor(F.col("id") / len(cases)), F.lit(6))
    candidate, before, label = F.lit(""), F.lit(""), F.lit(0)
    for at, (value, near, kind_label) in enumerate(cases):
        candidate, before = F.when(kind == at, value).otherwise(candidate), F.when(kind == at, near).otherwise(before)
        label = F.when(kind == at, kind_label).otherwise(label)
    # In every sixth finding the path speaks against a secret, in another sixth the words after it.
    path = F.when(place == 0, pick(_EXAMPLE_PATHS)).otherwise(pick(_PATHS))
    after = F.when(place == 1, pick(_EXAMPLE_AFTER)).otherwise(pick(_AFTER))
    label = F.when(place < 2, 0).otherwise(label).cast("double")
    return df.select(path.alias("path"), before.alias("before"), candidate.alias("candidate"), after.alias("after"), label.alias("label"))


def train(findings: DataFrame):
    """The forest for labelled findings, of which at most LABELLED, chosen by hash, are used."""
    rows = findings.where("label IS NOT NULL").orderBy(F.xxhash64("before", "candidate", "path", "after"), "candidate").limit(LABELLED)
    rows = features(rows)
    names = [c for c in rows.columns if c.startswith("x_")]
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
    return forest.fit(VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("features", "label"))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, path, at (place of the word), before, candidate, after for each candidate of the whole texts."""
    words = F.array_remove(F.split(common.text_or_empty(), _BREAK), "")
    df = docs.select("doc_id", F.col("source").cast("string").alias("path"), words.alias("words"))

    def follows(i: Column) -> Column:
        sign = F.coalesce(F.get("words", i - 1).rlike(rf"[:=>][\"'`(]*$|(?i:bearer|basic)$"), F.lit(False))
        return sign & F.concat_ws(" ", F.get("words", i - 2), F.get("words", i - 1)).rlike(_SIGNED)

    def wanted(i: Column) -> Column:
        word = F.get("words", i)
        long = (F.length(word) >= 16) & word.rlike(_CANDIDATE)
        return long | word.rlike(rf"{_ASSIGNED}|{_URL}|{_VENDOR}") | follows(i)

    places = F.filter(F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)), wanted)
    # No filter on these columns, nor explode(), which implies one: it would be pushed below the projection, and the words
    # split again for each place.
    df = df.withColumn("places", places)

    def near(i: Column) -> Column:
        word = F.get("words", i)
        two, next_two = ([F.coalesce(F.get("words", i + k), F.lit("")) for k in ks] for ks in ((-2, -1), (1, 2)))
        return F.struct(i.alias("at"), F.concat_ws(" ", *two).alias("before"), word.alias("word"), F.concat_ws(" ", *next_two).alias("after"))

    df = df.withColumn("found", F.transform("places", near)).select("doc_id", "path", F.explode_outer("found").alias("f"))

    def pairs(pattern: str) -> Column:
        heads, values = (F.regexp_extract_all("f.word", F.lit(pattern), F.lit(k)) for k in (1, 2))
        return F.zip_with(heads, values, lambda head, value: F.struct(head.alias("head"), value.alias("value")))

    def alone(values: Column) -> Column:
        return F.transform(values, lambda c: F.struct(F.left("f.word", F.position(c, "f.word") - 1).alias("head"), c.alias("value")))

    after_sign = F.col("f.before").rlike(_SIGNED)
    value = F.when(after_sign, F.regexp_extract_all("f.word", F.lit(rf"^[\"'`(]*({_VALUE})"), F.lit(1))).otherwise(F.array().cast("array<string>"))
    vendor, runs = (alone(F.regexp_extract_all("f.word", F.lit(pattern), F.lit(1))) for pattern in (_VENDOR, f"({_CANDIDATE})"))
    named = F.concat(pairs(_ASSIGNED), alone(value), pairs(_URL), vendor)
    # A run that is part of a longer value (a token of several parts) is no candidate of its own.
    runs = F.filter(runs, lambda x: ~F.exists(named, lambda y: (F.length(y["value"]) > F.length(x["value"])) & y["value"].contains(x["value"])))
    every = F.concat(named, runs)
    first = F.filter(every, lambda x, i: (F.array_position(F.transform(every, lambda y: y["value"]), x["value"]) == i + 1))
    df = df.withColumn("c", F.explode(first))
    return df.select("doc_id", "path", F.col("f.at").alias("at"), F.concat_ws(" ", "f.before", "c.head").alias("before"), F.col("c.value").alias("candidate"), F.col("f.after").alias("after"))


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """doc_id, at, shown (the candidate's first four characters), length, sha256, probability, is_secret for each
    candidate of docs (doc_id, text, source).

    Null and empty texts have no candidates; a null source is an empty path; rows without doc_id are scanned too;
    repeated rows give repeated results. Other columns are ignored. An empty table gives an empty result.
    """
    model = train(labelled_findings(docs.sparkSession) if findings is None else findings)
    found = features(candidates(docs))
    names = [c for c in found.columns if c.startswith("x_")]
    judged = model.setRawPredictionCol("").setPredictionCol("").setProbabilityCol("_p")
    out = judged.transform(VectorAssembler(inputCols=names, outputCol="features").transform(found))
    return out.select(
        "doc_id",
        "at",
        F.substring("candidate", 1, 4).alias("shown"),
        F.length("candidate").cast("long").alias("length"),
        F.sha2("candidate", 256).alias("sha256"),
        vector_to_array("_p")[1].alias("probability"),
    ).withColumn("is_secret", F.col("probability") >= THRESHOLD)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of all documents, judged by the forest; scan() says what odd rows give."""
    return scan(common.table(spark, sf_dir, "documents"))

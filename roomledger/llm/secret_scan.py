"""Secrets in texts: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.rolling import together
from roomledger.session import work_folder

CANDIDATE = re.compile(r"[A-Za-z0-9_+/\-]{16,}={0,2}")
# Parts of names that name a secret for sure, that may name one, and that make the latter sure.
STRONG = {"token", "password", "passwd", "pwd", "pass", "passphrase", "passcode", "secret", "apikey", "bearer", "credential", "credentials"}
WEAK, SURE_WITH_WEAK = {"key", "auth", "authorization"}, {"api", "access", "private", "signing", "encryption", "client"}
ENDINGS = ("password", "passwd", "secret", "token", "apikey")
# Parts of names of digests and other things that look like keys.
DIGESTS = {"sha", "md", "md5", "sha1", "sha256", "commit", "checksum", "digest", "hash", "etag", "revision", "uuid", "id", "path", "file", "url"}
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# Any value assigned to such a name, and what stands for a user in a URL.
OPERATOR = re.compile(r":=|=>|==?|:")
NAME_END = re.compile(r"([\w.\-]+)[\"'\])]{0,2}[ \t]{0,16}\Z")
# Quoted parts are taken whole or not at all, so a quote left open costs one look along its line.
VALUE = re.compile(r"[ \t]{0,16}(?:(?:bearer|basic)[ \t]++)?(?:\"([^\"\n]*+)\"|'([^'\n]*+)'|([^\s\"'`]++))", re.I)
NAMED = re.compile(r"([\w.\-]+)[\"'\])]{0,2}[ \t]{0,16}(:=|=>|==?|:)[ \t]{0,16}(?:(?:bearer|basic)[ \t]+)?[\"']?$", re.I)
URL_USER = re.compile(r"://([^\s/:@\"'<>]*)(?::([^\s/\"'<>]+))?@")
URL_BEFORE = re.compile(r"://[^\s/:@\"'<>]*:?$")
KEY_ID = re.compile(r"(AKIA|ASIA)[0-9A-Z]{16}$")
UUID = re.compile(r"[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")
HEXADECIMAL = re.compile(r"[0-9a-fA-F]+$")
WORD_BEFORE, WORD_AFTER = re.compile(r"(\w+)\W*$"), re.compile(r"\W*(\w+)")
AROUND = 96
# At most about so many labelled findings train the forest.
MOST_LABELLED = 20_000
TREES, DEPTH, SEED = 20, 6, 7
# Trigrams that make up this share of all letters' trigrams are the dictionary.
COMMON = 0.98
REPLACEMENT = "[secret]"

FEATURES = (
    "size", "digits", "upper", "symbols", "transitions", "entropy", "coverage", "hexadecimal",
    "named", "assigned", "quoted", "before_coverage", "after_coverage", "path",
    "equals", "url", "known_form", "uuid", "separators", "slashes", "digest_named", "letters_run",
)

_LETTER = np.zeros(256, "i4")
for _k in range(26):
    _LETTER[97 + _k] = _LETTER[65 + _k] = _k + 1
TRIGRAMS = 27**3


def trigrams(text: bytes) -> np.ndarray:
    """Codes of all runs of three ASCII letters, case folded."""
    codes = _LETTER[np.frombuffer(text, "u1")]
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    return ((a * 27 + b) * 27 + c)[(a > 0) & (b > 0) & (c > 0)]


def dictionary(rows: DataFrame) -> np.ndarray:
    """Which of the TRIGRAMS (a fixed number) are common in all the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TRIGRAMS, "i8")
        for _, texts in together(batches):
            total += np.bincount(trigrams("\n".join(texts).encode()), minlength=TRIGRAMS)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at])], names=["code", "n"])

    found = rows.select("doc_id", "text").mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    common = np.zeros(TRIGRAMS, bool)
    found = found.sort_values(["n", "code"], ascending=[False, True])
    share = found["n"].cumsum() - found["n"]
    common[found["code"][share < COMMON * found["n"].sum()]] = True
    return common


def coverage(word: str, common: np.ndarray) -> float:
    """Share of a word's letter trigrams that are common, among all its runs of three."""
    raw = word.encode()
    return float(common[trigrams(raw)].sum()) / max(len(raw) - 2, 1)


def kind(char: str) -> int:
    return 0 if char.islower() else 1 if char.isupper() else 2 if char.isdigit() else 3


def named(name: str) -> int:
    """Whether a name, by its parts, names a secret: 2 for sure, 1 perhaps, 0 not."""
    parts = {p.lower() for p in PARTS.findall(name)}
    weak = bool(parts & WEAK)
    if parts & STRONG or (weak and parts & SURE_WITH_WEAK) or any(p.endswith(ENDINGS) for p in parts):
        return 2
    return int(weak)


def candidates(text: str) -> list[tuple[int, int]]:
    """Places of all candidates, in order: assigned to a secret's name, in URLs, and long runs of key characters."""
    found: dict[int, int] = {}
    at = 0
    while m := OPERATOR.search(text, at):
        at = m.end()
        name = NAME_END.search(text[max(0, m.start() - AROUND) : m.start()])
        if not name or not named(name[1]) or text.startswith("//", at):
            continue
        value = VALUE.match(text, at)
        if not value:
            continue
        low, high = value.span(value.lastindex)
        own = value[value.lastindex]
        own = own.rstrip(",;.)]}>") if value.lastindex == 3 else own
        if not own.strip():
            continue
        high = low + len(own)
        at = max(high, at)
        if not text.startswith(REPLACEMENT, low):
            found[low] = high
    for m in URL_USER.finditer(text):
        low, high = m.span(2 if m[2] else 1)
        if high > low and not text.startswith(REPLACEMENT, low):
            found[low] = max(high, found.get(low, 0))
    for m in CANDIDATE.finditer(text):
        found.setdefault(m.start(), m.end())
    return sorted(found.items())


def features(text: str, start: int, end: int, path: int, common: np.ndarray) -> tuple[float, ...]:
    value = text[start:end]
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    kinds = [kind(c) for c in value]
    counts = np.unique(list(value), return_counts=True)[1] / len(value)
    name = NAMED.search(before)
    word, following = WORD_BEFORE.search(before), WORD_AFTER.match(after)
    run = max((len(r) for r in re.findall(r"[^\W\d_]+", value)), default=0)
    parts = {p.lower() for p in PARTS.findall(name[1] if name else word[1] if word else "")}
    return (
        float(len(value)), kinds.count(2) / len(value), kinds.count(1) / len(value), kinds.count(3) / len(value),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(len(value) - 1, 1), float(-(counts * np.log2(counts)).sum()),
        coverage(value, common), float(bool(HEXADECIMAL.match(value))),
        float(named(name[1] if name else word[1] if word else "")), float(bool(name)),
        float(before[-1:] in ("'", '"') and after[:1] == before[-1:]),
        coverage(word[1], common) if word else 0.0, coverage(following[1], common) if following else 0.0, float(path),
        float(bool(name and "=" in name[2])), float(bool(URL_BEFORE.search(before) and after[:1] == "@")),
        float(bool(KEY_ID.match(value))), float(bool(UUID.match(value))),
        sum(c in "-_/." for c in value) / len(value), float(value.count("/")), float(bool(parts & DIGESTS)), run / len(value),
    )


def label(text: str, start: int, end: int) -> int | None:
    """What a rule holds of a finding, to teach the forest and not to decide: 1 a secret, 0 none, NULL unknown.

    A long run of digits and letters assigned to the name of a secret is one, unless it has
    the form of a UUID or path, and so is a key id of the known form. Without such a name, letters
    alone, digits alone, UUIDs, and digests with the name of one are none.
    """
    value = text[start:end].rstrip("=")
    before = text[max(0, start - AROUND) : start]
    name = NAMED.search(before)
    mixed = any(map(str.isdigit, value)) and any(map(str.isalpha, value))
    if KEY_ID.match(value):
        return 1
    if name and named(name[1]):
        return 1 if mixed and CANDIDATE.fullmatch(value) and "/" not in value and not UUID.match(value) else None
    if URL_BEFORE.search(before) and text[end : end + 1] == "@":
        return None
    digest = name and HEXADECIMAL.match(value) and {p.lower() for p in PARTS.findall(name[1])} & DIGESTS
    return 0 if value.isalpha() or value.isdigit() or UUID.match(value) or digest else None


def examples() -> list[tuple[str, int, int, int]]:
    """Made findings whose label is known: text, start, end, label. Always the same ones.

    Secrets: keys, passwords and letters or digits alone with the name of a secret, passwords in
    URLs, key ids. None: digests, UUIDs, paths, identifiers, placeholders and words, also with such a name.
    """
    rng = np.random.default_rng(SEED)
    lower, digit, base62 = "abcdefghijklmnopqrstuvwxyz", "0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    plain = "stone river light over under walk near again user order value name table config static image index main test data".split()
    strong = "password db_password client_secret access_token token api_key apiKey DB_PASSWORD passwd secret authToken pwd".split()
    weak = "key cache_key primary_key partition_key sort-key auth".split()
    digests = "sha256 md5 commit checksum etag revision file_hash request_id uuid id".split()

    def any_of(chars: str, least: int, most: int) -> str:
        return "".join(rng.choice(list(chars), int(rng.integers(least, most + 1))))

    def words(n: int, between: str) -> str:
        return between.join(rng.choice(plain, n))

    def hexadecimal() -> str:
        return "".join(rng.choice(list("0123456789abcdef"), int(rng.choice([32, 40, 64]))))

    def uuid() -> str:
        return "-".join("".join(rng.choice(list("0123456789abcdef"), n)) for n in (8, 4, 4, 4, 12))

    def path() -> str:
        return str(rng.choice(["/", "", "./"])) + words(int(rng.integers(2, 6)), "/") + any_of(digit, 0, 2) + str(rng.choice(["", ".png", ".py"]))

    def identifier() -> str:
        return words(int(rng.integers(2, 5)), str(rng.choice(["_", "-", "."]))) + any_of(digit, 0, 2)

    def password() -> str:
        return words(1, "") + any_of(digit, 1, 4) + any_of("!@#$.:%" + lower, 0, 5)

    secret = [
        lambda: any_of(base62, 16, 64), hexadecimal, password, password, lambda: any_of(base62 + "!@#$%.:-", 8, 24),
        lambda: any_of(base62 + "+/", 24, 60) + "=", lambda: any_of(lower, 12, 32), lambda: any_of(digit, 8, 24),
    ]
    other = [path, identifier, uuid, lambda: "${" + words(1, "").upper() + "}", lambda: "<" + words(1, "") + ">",
             lambda: str(rng.choice(["None", "null", "true", "false", "x", "xxxxxxxx", "********", "...", "required", "self"]))]
    made = []

    def put(name: str, value: str, known: int, quote: str | None = None, sign: str | None = None) -> None:
        quote = str(rng.choice(["", '"', "'"])) if quote is None else quote
        sign = str(rng.choice(["=", " = ", ": ", "="])) if sign is None else sign
        front = words(4, " ") + " " + (name + sign if name else "") + quote
        made.append((front + value + quote + " " + words(4, " "), len(front), len(front) + len(value), known))

    for _ in range(60):
        for make in secret:
            put(str(rng.choice(strong)), make(), 1)
        put("key", any_of(base62, 20, 48), 1)
        put("", "AKIA" + any_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 16), 1, "")
        user, host = words(1, ""), words(2, ".")
        for value in (password(), any_of(base62, 6, 20), any_of(lower, 6, 12)):
            front = words(3, " ") + " postgres://" + user + ":"
            made.append((front + value + "@" + host + "/" + words(1, ""), len(front), len(front) + len(value), 1))
        front = words(3, " ") + " ssh://"
        made.append((front + user + "@" + host + "/x", len(front), len(front) + len(user), 0))
        for make in other:
            put(str(rng.choice(weak)), make(), 0)
            put(str(rng.choice(strong)), make(), 0)
        put(str(rng.choice(strong + weak)), words(1, ""), 0, "", ": ")
        for make in (hexadecimal, uuid):
            put(str(rng.choice(digests)), make(), 0)
            put("", make(), 0)
        put(str(rng.choice(weak)), words(3, ""), 0)
        put("", path(), 0, "")
        put("", words(4, "_"), 0, "")
        put("", "https:/" + path(), 0, "")
    return made


def findings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str = "source") -> DataFrame:
    """All candidates of all texts with their features and, where known, their label.

    doc_id, text_hash, start, length (in characters), label, and FEATURES.
    """
    rows = _rows(docs, id_column, text_column, path_column)
    return _findings(rows, dictionary(rows))


def _rows(docs: DataFrame, id_column: str, text_column: str, path_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        F.pmod(F.xxhash64(F.coalesce(F.col(path_column).cast("string"), F.lit(""))), F.lit(16)).alias("path"),
    )


def _findings(rows: DataFrame, common: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_hash", "start", "length", "label", *FEATURES]
        types = [pa.int64()] * 4 + [pa.int32()] + [pa.float64()] * len(FEATURES)
        for batch in batches:
            out = []
            for doc, text, path, hash_ in zip(*(c.to_pylist() for c in batch.columns)):
                for low, high in candidates(text):
                    out.append((doc, hash_, low, high - low, label(text, low, high), *features(text, low, high, path, common)))
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    schema = "doc_id bigint, text_hash bigint, start bigint, length bigint, label int, " + ", ".join(f"{f} double" for f in FEATURES)
    return rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, schema)


def secrets(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    path_column: str = "source",
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """One row per candidate: doc_id, text_hash, start, length, probability, is_secret.

    Candidates are runs of 16 or more key characters anywhere in a text, any value that is not
    blank and assigned to a name with a part that names a secret, and users and passwords in
    URLs; they may overlap. A random forest on length, transitions between kinds of characters,
    dictionary coverage, path and the words beside decides them. It learns from labelled findings:
    columns doc_id, start and label (1 secret, 0 none) where given in both kinds, else also
    from examples() and from the findings that label() knows; about most_labelled of the
    table's own by a hash of their place, evenly over both kinds. What only the rule says
    teaches less: a name that may name a secret makes no finding one, and findings of one kind
    and sort of name are at most as many as the made ones, so that a false positive is not
    learnt the better the more often it occurs.

    A place with a given label keeps it; no other rule decides. NULL and empty texts have no
    candidates; NULL path is an empty one. Rows that repeat are found each. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "secrets")
    rows = _rows(docs, id_column, text_column, path_column)
    common = dictionary(rows)
    _findings(rows, common).write.parquet(folder)
    found = spark.read.parquet(folder).withColumn("given", F.lit(None).cast("int"))
    taught = False
    if labelled is not None:
        known = labelled.select(
            F.col("doc_id").alias("_doc"), F.col("start").alias("_start"), F.col("label").cast("int").alias("_label")
        ).dropDuplicates(["_doc", "_start"])
        found = found.drop("given").join(
            known, found["doc_id"].eqNullSafe(known["_doc"]) & (found["start"] == known["_start"]), "left"
        ).withColumnRenamed("_label", "given").drop("_doc", "_start")
        taught = found.filter("given is not null").select("given").distinct().count() == 2
        found = found.withColumn("label", F.col("given") if taught else F.coalesce("given", "label"))

    keep = ["doc_id", "text_hash", "start", "length"]
    columns = [*keep[:1], *keep[2:], "label", *FEATURES]
    made = [] if taught else [
        (-1 - k, start, end - start, known, *features(text, start, end, k % 16, common))
        for k, (text, start, end, known) in enumerate(examples())
    ]
    sure = F.col("given").isNotNull()
    doubtful = (F.col("label") == 1) & (F.col("named") == 1) & (F.col("known_form") == 0) & ~sure
    teaching = found.filter(F.col("label").isNotNull() & ~doubtful).withColumn("sure", sure)
    # Six kinds of label and name at most, for given labels and for those of the rule.
    at_named = columns.index("named")
    sizes = teaching.groupBy("label", "named", "sure").count().collect()
    totals = {k: sum(r["count"] for r in sizes if r.label == k) for k in (0, 1)}
    share = F.lit(0.0)
    for r in sizes:
        part = most_labelled / 2 / totals[r.label]
        if not r.sure:
            part = min(part, sum(row[3] == r.label and row[at_named] == r.named for row in made) / r["count"])
        kind_ = (F.col("label") == r.label) & (F.col("named") == r.named) & (F.col("sure") == F.lit(r.sure))
        share = F.when(kind_, F.lit(min(part, 1.0))).otherwise(share)
    fine = 1 << 30
    at = F.pmod(F.xxhash64("doc_id", "start"), F.lit(fine))
    chosen = teaching.filter(at < share * fine).select(*columns)
    if made:
        chosen = chosen.unionByName(spark.createDataFrame(made, chosen.schema))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    # A bounded number of rows, in one order, so that the forest is the same every time.
    training = assemble.transform(chosen.withColumn("label", F.col("label").cast("double")).coalesce(1).sort("doc_id", "start", "length"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label").fit(training)
    judged = forest.transform(assemble.transform(found))
    probability = vector_to_array("probability").getItem(1)
    return judged.select(
        *keep,
        probability.alias("probability"),
        F.coalesce(F.col("given") == 1, probability >= 0.5).alias("is_secret"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with each secret replaced, all columns kept; n_chars follows the text."""
    hits = (
        secrets(docs).filter("is_secret").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "start", "length")
        .distinct()
        .groupBy("_id", "_hash")
        .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_spans"))
    )

    @F.udf("string", useArrow=True)
    def replaced(text: str | None, spans: list | None) -> str | None:
        if not spans:
            return text
        parts, at = [], 0
        end = 0
        for span in spans:  # spans that overlap are one
            if span["start"] >= end:
                parts += [text[at : span["start"]], REPLACEMENT]
            at = end = max(end, span["start"] + span["length"])
        return "".join([*parts, text[at:]])

    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col("_id")) & (
        F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == F.col("_hash")
    )
    joined = docs.join(hits, same, "left")
    new = replaced(F.col("text"), F.col("_spans"))
    size = F.when(F.col("_spans").isNotNull(), F.char_length(new)).otherwise(F.col("n_chars"))
    columns = {"text": new.alias("text"), "n_chars": size.cast(docs.schema["n_chars"].dataType).alias("n_chars")}
    return joined.select(*[columns.get(c, F.col(c)) for c in docs.columns])

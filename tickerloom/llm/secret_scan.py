"""Operator 1: secrets in texts, with a random forest that removes false positives. SQL functions only.

A text is cut into runs and what lies between them. A run is an assigned value (in quotes behind = or :, or right
behind =) or eight or more letters, digits and + / _ -. Candidates are the assigned values and the other runs with a
digit or, from twelve characters on, with a change from small to large letters. The forest sees a candidate's
length, its kinds of characters and the changes between them, how likely its character transitions are in the words of
the corpus, how much of it dictionary words cover, its path (the document's source) and the words beside it, weighted by
how often labelled findings have them. It is trained from labelled findings by Spark's own implementation and then
written out as nested CASE expressions, so that scanning is one pass over the texts without any shuffle.

The transition table and the dictionary come from all words of all texts. The forest and the words' weights are fitted on
labelled findings: `fit_scanner` takes any table of them. The given tables hold none, so `train` takes the candidates of
about SAMPLE_DOCS documents, SAMPLE_FINDINGS at most (documented bounds), and `label_findings` marks
known formats of keys and mixed values that are assigned. The syntax of an assignment is no feature of the forest; it has
to tell secrets by the value itself, the path and the words around, and so finds them without that syntax, too.

Results by case: null and empty texts have no findings; without labelled findings of both kinds the score is
the share of true ones (nothing is known: 0); a null source is an empty path; rows with null doc_id are
scanned but not learned from; repeated rows stay, each with its findings; words and findings that tie are
taken by their spelling; a very long text is scanned whole in one task, in memory linear in its length and in time but for a sum over
one in 4,096 of its runs for each of these (a million candidates are 244 of them); an empty
table gives an empty result; extra columns of any name are kept by scan and redact and passed over by the query.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.tables import saved, table

SAMPLE_DOCS = 20_000
SAMPLE_FINDINGS = 20_000
DICTIONARY_WORDS = 300
#: Words beside findings that have a weight, and in how many findings they must stand.
NEIGHBOUR_WORDS, NEIGHBOUR_LEAST = 100, 5
TREES, DEPTH = 15, 4
THRESHOLD = 0.5
#: Runs whose lengths are summed at once to find a candidate's place.
BLOCK = 64
REDACTED = "[SECRET]"

# patterns as they stand in SQL strings
_QUOTE, _PLAIN = r'["\\x27\\x60]', r'[^\\s"\\x27\\x60]'
_ASSIGNED = rf"[=:]\\s?{_QUOTE}{_PLAIN}{{6,}}{_QUOTE}|=[^\\s=\"\\x27\\x60]{{8,}}"
_RUN = rf"{_ASSIGNED}|[A-Za-z0-9+/_-]{{8,}}"
#: What any text with a candidate matches.
_LIKELY = rf"[A-Za-z0-9+/_-]{{4}}[0-9]|[0-9][A-Za-z0-9+/_-]{{4}}|[a-z][A-Z]|{_ASSIGNED}"
_OPENING = rf"^(=(?:\\s?{_QUOTE})?|:\\s?{_QUOTE})"
#: Characters of the transition table; digits count as 0 and all else as the last.
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0_"
#: Characters before and after a candidate in which its neighbouring words are looked for.
_BEFORE, _AFTER = 48, 24

FEATURES = ("length", "digits", "upper", "changes", "transitions", "coverage", "neighbours", "path_depth", "test_path")


def _free_name(docs: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _bound(value: str, name: str, body: str) -> str:
    """SQL for body with a name for a value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def with_candidates(docs: DataFrame) -> DataFrame:
    """docs with one more column, last and under a free name: parts and runs, which make up the text in turns, and found, the candidates among the runs."""
    path = "coalesce(cast(source as string), '')" if "source" in docs.columns else "''"
    name = _free_name(docs, "scan")
    cut = docs.withColumn(name, F.expr(f"if(text rlike '{_LIKELY}', named_struct('parts', split(text, '{_RUN}'), 'runs', regexp_extract_all(text, '({_RUN})', 1)), null)"))
    run, part, part_i = f"get({name}.runs, i)", f"{name}.parts", f"get({name}.parts, i)"
    chosen = f"filter(sequence(0, size({name}.runs)), i -> {run} rlike '^[=:]|[0-9]' or (length({run}) >= 12 and {run} rlike '[a-z][A-Z]'))"
    opening = f"if({run} rlike '^[=:]', regexp_extract({run}, '{_OPENING}', 1), '')"
    value = f"if({run} rlike '^[=:]', regexp_replace({run}, '{_OPENING}|{_QUOTE}$', ''), {run})"
    # a run's start: sums over blocks of BLOCK * BLOCK runs, then over its blocks of BLOCK runs, then over its own block
    total = lambda xs, first, n: f"aggregate(slice({xs}, cast({first} + 1 as int), cast({n} as int)), 0, (a, x) -> a + x)"
    start = f"get(large, cast(i div {BLOCK * BLOCK} as int)) + {total('small', f'(i div {BLOCK * BLOCK}) * {BLOCK}', f'(i div {BLOCK}) % {BLOCK}')} + {total('each', f'(i div {BLOCK}) * {BLOCK}', f'i % {BLOCK}')} + length({part_i}) + length({opening})"
    before = f"right(concat(coalesce(right(get({part}, i - 1), {_BEFORE}), ''), coalesce(get({name}.runs, i - 1), ''), right(get({part}, i), {_BEFORE}), {opening}), {_BEFORE})"
    after = f"left(concat(left(get({part}, i + 1), {_AFTER}), coalesce(get({name}.runs, i + 1), ''), coalesce(left(get({part}, i + 2), {_AFTER}), '')), {_AFTER})"
    found = f"transform({chosen}, i -> named_struct('run', i, 'value', {value}, 'start', {start}, 'before', {before}, 'after', {after}, 'path', {path}))"
    blocks = lambda xs: f"transform(sequence(0, cast(greatest(size({xs}) - 1, 0) div {BLOCK} as int)), j -> {total(xs, f'j * {BLOCK}', BLOCK)})"
    found = _bound(blocks("small"), "sums", _bound(f"transform(sequence(0, size(sums) - 1), j -> {total('sums', '0', 'j')})", "large", found))
    found = _bound(f"transform({name}.runs, (r, i) -> length({part_i}) + length(r))", "each", _bound(blocks("each"), "small", found))
    return cut.withColumn(name, F.expr(f"named_struct('parts', {part}, 'runs', {name}.runs, 'found', {found})"))


class Scanner:
    """What is learned: the cost of each character transition, the most frequent words, the weights of neighbouring words and the forest."""

    def __init__(self, transitions: str, words: list[str], weights: dict[str, float] | None = None, forest: Forest | None = None):
        self.transitions, self.words, self.weights, self.forest = transitions, words, weights or {}, forest or Forest([0.0])


class Forest:
    """Trees as nested tuples (feature, threshold, left, right) or a leaf's share of true findings."""

    def __init__(self, trees: list):
        self.trees = trees

    def sql(self, x: str) -> str:
        def node(t) -> str:
            return f"{t!r}D" if isinstance(t, float) else f"CASE WHEN {x}[{t[0]}] <= {t[1]!r}D THEN {node(t[2])} ELSE {node(t[3])} END"

        return "(" + " + ".join(map(node, self.trees)) + f") / {len(self.trees)}D"


def learn_vocabulary(texts: DataFrame) -> Scanner:
    """Transitions and dictionary from all words of all texts, a row a distinct word in between; the results have a fixed size."""
    words = texts.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")).where("length(w) >= 3").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    words = saved(words, "words")
    often = [r.w for r in words.orderBy(F.desc("n"), "w").limit(DICTIONARY_WORDS).collect()]
    pairs = words.select("n", F.explode(F.expr("element_at(transform(array(split(w, '')), c -> transform(slice(c, 2, size(c)), (x, i) -> concat(get(c, i), x))), 1)")).alias("p")).groupBy("p").agg(F.sum("n").alias("n")).collect()  # 26 * 26 rows at most
    counts = {r.p: r.n for r in pairs}
    total, size = sum(counts.values()), len(_ALPHABET)
    # one character for each transition, from ( up: its cost in thirds of a nat
    cost = [round(3 * math.log((total + size * size) / (counts.get(a + b, 0) + 1))) for a in _ALPHABET for b in _ALPHABET]
    return Scanner("".join(chr(40 + min(80, c)) for c in cost), often)


def _neighbours(f: str) -> str:
    return f"filter(split(lower(concat({f}.before, ' ', {f}.after)), '[^a-z]+'), w -> length(w) >= 3)"


def _features(f: str, scanner: Scanner) -> str:
    """SQL for the features of the candidate f, in the order of FEATURES."""
    n = f"length({f}.value)"
    plain = f"regexp_replace(translate(lower({f}.value), '123456789', '000000000'), '[^a-z0]', '_')"
    size = len(_ALPHABET)
    transitions = scanner.transitions.replace("\\", "\\\\")  # quotes are below its first character
    place = lambda c: f"locate({c}, '{_ALPHABET}')"
    # characters as an array, as a place in a string is found by counting from its start
    each = f"aggregate(transform(slice(y, 2, size(y)), (c, i) -> ascii(substring('{transitions}', {size} * ({place('get(y, i)')} - 1) + {place('c')}, 1)) - 40), 0D, (a, c) -> a + c)"
    cost = f"element_at(transform(array(split({plain}, '')), y -> {each}), 1) / ({n} - 1)"
    changes = " + ".join(f"regexp_count({f}.value, '{p}')" for p in ("[a-z][0-9]", "[0-9][a-z]", "[A-Z][0-9]", "[0-9][A-Z]", "[a-z][A-Z]", "[A-Z][a-z]", "[^A-Za-z0-9]"))
    covered = f"1D - length(regexp_replace(lower({f}.value), '{'|'.join(scanner.words) or '^$'}', '')) / {n}"
    names, values = ", ".join(f"'{w}'" for w in scanner.weights), ", ".join(f"{v!r}D" for v in scanner.weights.values())
    near = f"aggregate({_neighbours(f)}, 0D, (a, w) -> a + coalesce(try_element_at(map_from_arrays(array({names}), array({values})), w), 0D))" if names else "0D"
    return ", ".join((
        f"cast({n} as double)", f"regexp_count({f}.value, '[0-9]') / {n}", f"regexp_count({f}.value, '[A-Z]') / {n}", f"({changes}) / {n}", cost, covered, near,
        f"cast(length({f}.path) - length(replace({f}.path, '/', '')) as double)", f"if({f}.path rlike '(?i)(test|example|fixture|docs)', 1D, 0D)",
    ))


def _changed(docs: DataFrame, fields: str) -> DataFrame:
    """The candidates f in the last column with other fields."""
    name = docs.columns[-1]
    return docs.withColumn(name, F.expr(f"named_struct('parts', {name}.parts, 'runs', {name}.runs, 'found', transform({name}.found, f -> named_struct({fields})))"))


def with_features(found: DataFrame, scanner: Scanner) -> DataFrame:
    """found with x, the array of FEATURES, in each candidate."""
    return _changed(found, f"'run', f.run, 'value', f.value, 'start', f.start, 'before', f.before, 'after', f.after, 'path', f.path, 'x', array({_features('f', scanner)})")


def each_finding(found: DataFrame, *keep: str) -> DataFrame:
    """A row for each candidate, with its fields and the columns to keep.

    explode_outer and a filter, as the filter that Spark derives from explode would be pushed below the
    candidates and split the text again for each of its words.
    """
    f = _free_name(found, "f")
    return found.select(*keep, F.explode_outer(F.col(found.columns[-1])["found"]).alias(f)).where(F.col(f).isNotNull()).select(*keep, f"{f}.*")


def label_findings(findings: DataFrame) -> DataFrame:
    """findings (value, before) with label: 1 for formats of keys and for assigned mixed values, else 0."""
    assigned = F.col("before").rlike("[=:]\\s*[\"'`]?$")
    mixed = (F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]")) | F.col("value").rlike("[a-z][A-Z]|[^A-Za-z0-9+/._-]")
    # fixed values: prefixes of providers' keys
    known = F.col("value").rlike("^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abp]-[0-9A-Za-z-]{10,}$|^sk_live_[0-9A-Za-z]{16,}$|^AIza[0-9A-Za-z_-]{35}$")
    return findings.withColumn("label", F.when(known | (assigned & mixed), 1.0).otherwise(0.0))


def neighbour_weights(findings: DataFrame) -> dict[str, float]:
    """Log-odds of the words beside labelled findings (before, after, label): NEIGHBOUR_WORDS at most, those that tell most."""
    n = {r.label: r.n for r in findings.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = findings.select("label", F.explode(F.array_distinct(F.expr(_neighbours("struct(before, after)")))).alias("w"))
    counts = words.groupBy("w").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q")).where(F.col("p") + F.col("q") >= NEIGHBOUR_LEAST)
    weight = F.log((F.col("p") + 0.5) / (n.get(1.0, 0) + 1.0)) - F.log((F.col("q") + 0.5) / (n.get(0.0, 0) + 1.0))
    rows = counts.select("w", F.round(weight, 4).alias("weight"), (F.abs(weight) * F.sqrt(F.col("p") + F.col("q"))).alias("tells")).orderBy(F.desc("tells"), "w").limit(NEIGHBOUR_WORDS).collect()
    return {r.w: r.weight for r in rows}


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        stats = list(node.impurityStats().stats())
        return float(stats[1] / sum(stats)) if sum(stats) else 0.0
    return int(node.split().featureIndex()), float(node.split().threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def fit_forest(findings: DataFrame, seed: int = 5) -> Forest:
    """A forest from labelled findings (x, label)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    counts = {r.label: r.n for r in findings.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Forest([float(max(counts, default=0.0))])
    rows = findings.select(array_to_vector("x").alias("features"), "label")
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", seed=seed).fit(rows)
    return Forest([_tree(t._java_obj.rootNode()) for t in model.trees])


def fit_scanner(vocabulary: Scanner, findings: DataFrame) -> Scanner:
    """The scanner from labelled findings (value, before, after, path, label)."""
    weighted = Scanner(vocabulary.transitions, vocabulary.words, neighbour_weights(findings))
    own = saved(findings.select("label", F.expr("struct(value, before, after, path)").alias("f")).select("label", F.expr(f"array({_features('f', weighted)})").alias("x")), "features")
    return Scanner(vocabulary.transitions, vocabulary.words, weighted.weights, fit_forest(own))


def train(docs: DataFrame) -> Scanner:
    """The scanner of a corpus: its vocabulary from all texts, the rest from a bounded sample of findings, marked by label_findings."""
    path = F.col("source").cast("string") if "source" in docs.columns else F.lit("")
    own = docs.where("doc_id is not null and text is not null").select("text", path.alias("source"), F.xxhash64("doc_id", F.lit(17)).alias("h"))
    vocabulary = learn_vocabulary(docs.select("text"))
    share = min(1.0, SAMPLE_DOCS / max(1, own.count()))
    sampled = own.where(F.pmod("h", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    found = each_finding(with_candidates(sampled), "h")
    findings = saved(label_findings(found.orderBy("h", "run", "value").limit(SAMPLE_FINDINGS)), "findings")
    return fit_scanner(vocabulary, findings)


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """docs with one more column, last and under a free name: its field found has run, value, start and score of each candidate; secrets are those of THRESHOLD and over."""
    return _changed(with_features(with_candidates(docs), scanner), f"'run', f.run, 'value', f.value, 'start', f.start, 'score', {scanner.forest.sql('f.x')}")


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Every candidate with its place in the text, its score and whether it stays; the secrets themselves appear as digests."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    found = each_finding(scan(docs, train(docs)), "doc_id")
    return found.select("doc_id", "start", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= THRESHOLD).alias("is_secret"))


def redact(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """docs with REDACTED in the place of each secret, and n_chars, if there is such a column, counted anew."""
    out = scan(docs, scanner)
    name = out.columns[-1]
    # runs as odd numbers and secrets as the even ones before them: sorted, each secret stands right before its run
    secrets = f"transform(filter({name}.found, f -> f.score >= {THRESHOLD}D), f -> 2 * f.run)"
    mixed = f"sort_array(concat(transform({name}.parts, (p, i) -> 2 * i + 1), {secrets}))"
    marks = "filter(transform(mixed, (x, j) -> if(x % 2 = 1, if(j > 0 and get(mixed, j - 1) = x - 1, 1, 0), -1)), m -> m >= 0)"
    run = f"get({name}.runs, i)"
    cleaned = f"if(get(marks, i) = 1, concat(if({run} rlike '^[=:]', regexp_extract({run}, '{_OPENING}', 1), ''), '{REDACTED}', if({run} rlike '(?s)^[=:].*{_QUOTE}$', right({run}, 1), '')), coalesce({run}, ''))"
    whole = _bound(mixed, "mixed", _bound(marks, "marks", f"array_join(transform({name}.parts, (p, i) -> concat(p, {cleaned})), '')"))
    has: Column = F.exists(F.col(name)["found"], lambda f: f["score"] >= THRESHOLD)
    columns = {c: F.col(f"`{c}`") for c in docs.columns}
    columns["text"] = F.when(has, F.expr(whole)).otherwise(F.col("text")).alias("text")
    if "n_chars" in columns:
        columns["n_chars"] = F.when(has, F.length(F.expr(whole)).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias("n_chars")
    return out.select(*columns.values())

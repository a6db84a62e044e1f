"""Secret scans: a random forest that takes false positives out of pattern findings, with column expressions only.

Findings are long runs of key characters that hold a digit (after any sign, as in NAME=value), values assigned to a name
that tells of a secret, providers' forms, and private-key blocks. Each gets features: length, transitions between kinds of characters, shares of kinds,
coverage by dictionary words, whether it lies in a path, and neighbouring words. The forest is trained on a
bounded sample of labelled findings and then evaluated as one column expression inside each row, so
nothing is exploded or shuffled to scan the corpus.

Labelled findings can be given. Where there are none, as in the registered query, findings of the corpus
are labelled by their form: those with a provider's fixed form, or of random make-up and assigned to
a telling name, are secrets; the others are not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.llm import spans as S
from civicmart.llm.columns import sample
from civicmart.session import cut

#: Bound of the labelled sample of either class.
SAMPLE = 5000
TREES, DEPTH, SEED = 15, 5, 7
CONTEXT = 32
MASK = "[SECRET]"

NAMES = r"(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key|credential)"
#: A block ends at the next BEGIN or END, whatever it is of, so no two attempts read the same text.
KEY_BLOCK = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]{0,20}PRIVATE KEY-----"
#: An assignment to a telling name; the sign comes first, so that only signs look back.
TELLING = rf"[:=](?<=(?i:{NAMES})[\"']?\x20?[:=])"
ASSIGNED = rf"(?<=[:=\x20\"'])(?<=(?i:{NAMES})[\"']?\x20?[:=]\x20?[\"']?)[^\s\"'`,;<>]{{6,}}+"
RUN = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+={0,2}+"

# fixed values: forms of providers' keys, and words that a dictionary of code and prose would have
FORMS = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}+|github_pat_[0-9A-Za-z_]{22,}+|glpat-[0-9A-Za-z_-]{20,}+|xox[abprs]-[0-9A-Za-z-]{10,}+"
    r"|sk_live_[0-9A-Za-z]{16,}+|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]{10,}+"
)
#: How every form begins; only there the text is looked through for a digit, which stands within so many characters.
PREFIXES = r"(?:A[KS]IA|gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk_live_|AIza|eyJ)"
DIGIT_WITHIN = 255
#: A provider's form that holds a digit, wherever it begins, and in a finding, where it may follow a sign (as in //ghp_...).
PROVIDED = rf"(?<![A-Za-z0-9])(?={PREFIXES}[A-Za-z_-]{{0,{DIGIT_WITHIN}}}+[0-9])(?:{FORMS})"
PROVIDERS = rf"{PROVIDED}|^-----BEGIN "
WORDS = (
    "the and for with that this from have not are was has his her you your all can will one our out use new time name file path user test data "
    "code page text item value index list table order number version build release example sample default public static string class function "
    "module package config server client request response image style script content section title header footer"
).split()
REFERENCES = r"commit|checksum|sha1|sha256|md5|digest|uuid|etag|order|card|invoice|isbn|serial|revision"

FEATURES = [
    "length", "transitions", "digits", "upper", "hex", "other", "distinct", "words", "slashes", "in_path", "named", "assigned", "quoted", "reference", "provider",
]


def findings(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns, `text`, and `found`: every finding of the text with its place and features, in order."""
    text = F.col("text")
    telling = text.rlike(TELLING)
    block = F.contains(text, F.lit("PRIVATE KEY-----"))
    patterns = {
        "plain": (~telling & ~block & text.rlike("[0-9]"), f"{RUN}|{PROVIDED}"),
        "telling_found": (telling & ~block, f"{ASSIGNED}|{RUN}|{PROVIDED}"),
        "block_found": (block, f"{KEY_BLOCK}|{ASSIGNED}|{RUN}|{PROVIDED}"),
    }
    placed = S.with_matches(rows, patterns, (CONTEXT, 4))
    every = F.concat("plain", "telling_found", "block_found")
    return placed.select(*keep, "text", F.transform(every, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), *_features(m["text"], m["left"], m["right"]),
    )).alias("found"))


def _share(s: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(s, f"[^{kept}]", "")) / F.length(s)


def _features(s: Column, left: Column, right: Column) -> list[Column]:
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "b"), "[0-9]", "0")
    runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    uncovered = F.regexp_replace(F.lower(s), "|".join(sorted(WORDS, key=len, reverse=True)), "")
    values = {
        "length": F.length(s), "transitions": (runs - 1) / F.length(s), "digits": _share(s, "0-9"), "upper": _share(s, "A-Z"),
        "hex": _share(s, "0-9a-f"), "other": 1 - _share(s, "A-Za-z0-9"),
        "distinct": F.size(F.array_distinct(F.split(s, ""))) / F.length(s), "words": 1 - F.length(uncovered) / F.length(s),
        "slashes": F.length(s) - F.length(F.replace(s, F.lit("/"), F.lit(""))), "in_path": (left.rlike(r"[/\\.]$") | right.rlike(r"^[/\\.][a-z]")).cast("int"),
        "named": left.rlike(NAMES).cast("int"), "assigned": left.rlike(r"[:=]\s?[\"'`]?$").cast("int"),
        "quoted": left.rlike(r"[\"'`]$").cast("int"), "reference": left.rlike(REFERENCES).cast("int"), "provider": s.rlike(PROVIDERS).cast("int"),
    }
    return [values[n].cast("double").alias(n) for n in FEATURES]


def by_form(c: Column) -> Column:
    """The label of a finding where nobody gave one."""
    mixed = (c["digits"] > 0) & (c["words"] < 0.5) & (c["distinct"] * c["length"] >= 6)
    return (c["provider"] == 1) | ((c["named"] == 1) & (c["assigned"] == 1) & (c["reference"] == 0) & (c["in_path"] == 0) & mixed)


def train(labelled: DataFrame, bound: int = SAMPLE, trees: int = TREES, depth: int = DEPTH):
    """The forest's trees from rows of features and `label` (0 or 1), at most `bound` of either class.

    Findings with the same features and label count once. Null labels take no part. With one class only,
    its share stands for the forest.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    known = labelled.filter("label in (0, 1)").select(*FEATURES, F.col("label").cast("double").alias("label"))
    known = cut(known.distinct(), "secret-labelled")
    some = cut(reduce(DataFrame.union, [sample(known.filter(F.col("label") == y), bound, *FEATURES) for y in (0.0, 1.0)]), "secret-sample")
    n, yes = some.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if yes in (0, n):
        return float(yes > 0)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(some.coalesce(1))
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="sqrt").fit(rows.select("features", "label"))
    return [_nodes(t._call_java("rootNode")) for t in model.trees]


def _nodes(node):
    """A tree as nested (feature, threshold, left, right) with shares of secrets as leaves."""
    if node.getClass().getSimpleName() == "LeafNode":
        no, yes = node.impurityStats().stats()
        return yes / (no + yes)
    split = node.split()
    return (FEATURES[split.featureIndex()], split.threshold(), _nodes(node.leftChild()), _nodes(node.rightChild()))


def probability(c: Column, forest) -> Column:
    """The forest's mean share of secrets, as an expression of the features."""
    if isinstance(forest, float):
        return F.lit(forest)

    def tree(node) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        name, at, left, right = node
        return F.when(c[name] <= at, tree(left)).otherwise(tree(right))

    return reduce(lambda a, b: a + b, map(tree, forest)) / len(forest)


def _trained(found: DataFrame, labelled: DataFrame | None, **settings):
    if labelled is None:
        each = found.select(F.explode("found").alias("c"))
        labelled = each.select("c.*", by_form(F.col("c")).cast("int").alias("label"))
    return train(labelled, **settings)


def scan(docs: DataFrame, labelled: DataFrame | None = None, **settings) -> DataFrame:
    """doc_id, n_findings, n_secrets and spans (start:end of the secrets in code points, in order), one row per row of `docs`.

    Null and empty texts hold nothing; repeated rows are judged each for itself; other columns are not
    looked at; an empty table gives an empty one. `labelled` has the features of `findings` and `label`.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = cut(findings(rows, ["doc_id"]).drop("text"), "secret-findings")  # the texts are scanned once
    forest = _trained(found, labelled, **settings)
    secrets = F.filter("found", lambda c: probability(c, forest) >= 0.5)
    return found.select("doc_id", F.size("found").cast("bigint").alias("n_findings"), secrets.alias("s")).select(
        "doc_id", "n_findings", F.size("s").cast("bigint").alias("n_secrets"),
        F.array_join(F.transform("s", lambda c: F.concat(c["start"].cast("string"), F.lit(":"), c["end"].cast("string"))), ",").alias("spans"),
    )


def redact(docs: DataFrame, labelled: DataFrame | None = None, mask: str = MASK, **settings) -> DataFrame:
    """`docs` with every secret replaced by a mask; all rows and columns stay, null texts stay null."""
    learned = cut(findings(docs.select(F.coalesce("text", F.lit("")).alias("text")), []).select("found"), "secret-findings")
    forest = _trained(learned, labelled, **settings)
    others = F.struct("doc_id", *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]).alias("_row")
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.col("text").isNull().alias("_null"), others)
    found = findings(rows, ["_row", "_null"])
    secrets = found.select("_row", "_null", "text", F.filter("found", lambda c: probability(c, forest) >= 0.5).alias("s"))
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("s", lambda c: c["end"]))
    ends = F.concat(F.transform("s", lambda c: c["start"]), F.array(F.length("text").cast("bigint")))
    kept = F.zip_with(begins, ends, lambda b, e: F.substring(F.col("text"), (b + 1).cast("int"), (e - b).cast("int")))
    text = F.when(F.col("_null"), F.lit(None)).when(F.size("s") == 0, F.col("text")).otherwise(F.array_join(kept, mask))
    return secrets.select(*[text.alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])

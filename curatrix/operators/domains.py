"""Registered-domain labels of host names."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A short extract of the public suffix rules, in the list's own
# notation (`*.` any label, `!` exception). Pass the full list as a table for real use.
SUFFIX_RULES = (
    "com", "net", "org", "edu", "gov", "info", "io", "ai", "co", "eu", "fr", "de", "es", "it",
    "ch", "nl", "be", "ca", "us", "uk", "co.uk", "org.uk", "ac.uk", "gov.uk", "au", "com.au",
    "net.au", "jp", "co.jp", "in", "co.in", "br", "com.br", "sg", "com.sg", "hk", "com.hk",
    "cn", "com.cn", "za", "co.za", "nz", "co.nz", "*.ck", "!www.ck",
)

_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?+(?:[^/?#@]*@)?+(\[[^\]]*\]|[^/?#:]+)"
_NUMERIC = re.compile(r"\[.*|\d{1,3}(\.\d{1,3}){3}")

# Bounds of a list that every task holds; the public one has some 10,000 rules.
MOST_RULES = 200_000
MOST_CHARS = 8 << 20


def suffix_rules(spark: SparkSession, extra: tuple[str, ...] = ()) -> DataFrame:
    return spark.createDataFrame([(r,) for r in (*SUFFIX_RULES, *extra)], "rule string")


def read_suffix_rules(spark: SparkSession, path: str, with_private: bool = True) -> DataFrame:
    """Rules of the public suffix list's own file: comments and blank lines left out.

    A rule is the first word of its line. `with_private` keeps the part of the list that
    companies add; without it the file must be one split, which a list of its size is.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    if not with_private:
        begin = lines.filter(F.contains("line", F.lit("===BEGIN PRIVATE DOMAINS==="))).agg(F.min("at").alias("at")).scalar()
        lines = lines.filter(begin.isNull() | (F.col("at") < begin))
    rule = F.regexp_extract("line", r"^\s*(\S+)", 1)
    return lines.select(rule.alias("rule")).filter((F.col("rule") != "") & ~F.startswith("rule", F.lit("//"))).distinct()


def host_of(url: Column) -> Column:
    """Host of a url, also without scheme, with user or port, or with a final dot."""
    return F.regexp_replace(F.regexp_extract(url, _HOST, 1), r"\.+$", "")


@dataclass(frozen=True)
class SuffixTrie:
    """Suffix rules as a sorted array of keys: labels from the right, each ended by a dot.

    A rule holds for a host if its key is a prefix of the host's. The longest such key is
    the host's predecessor in the array or one of that key's own prefixes, to which
    `parents` leads; so one binary search finds it.
    """

    keys: list[str]
    parents: list[int]
    kinds: list[frozenset[str]]  # "", "*" (any label more), "!" (a label less)

    @classmethod
    def of(cls, rules: list[str]) -> SuffixTrie:
        kinds: dict[str, set[str]] = {}
        for rule in rules:
            bare = rule.lower().strip(".")
            kind = "*" if bare.startswith("*.") else "!" if bare.startswith("!") else ""
            bare = bare.removeprefix("*.").removeprefix("!")
            if bare:
                kinds.setdefault(_key(bare.split(".")), set()).add(kind)
        keys, parents, open_keys = sorted(kinds), [], []
        for i, key in enumerate(keys):
            while open_keys and not key.startswith(keys[open_keys[-1]]):
                open_keys.pop()
            parents.append(open_keys[-1] if open_keys else -1)
            open_keys.append(i)
        return cls(keys, parents, [frozenset(kinds[k]) for k in keys])

    def suffix_size(self, labels: list[str]) -> int:
        """Number of labels of the public suffix; 0 if no rule holds."""
        key = _key([label.lower() for label in labels])
        at = bisect_right(self.keys, key) - 1
        while at >= 0:
            if key.startswith(self.keys[at]):
                size, kinds = self.keys[at].count("."), self.kinds[at]
                if "!" in kinds:
                    return size - 1
                if "*" in kinds and len(labels) > size:
                    return size + 1
                if "" in kinds:
                    return size
            at = self.parents[at]
        return 0


def _key(labels: list[str]) -> str:
    return "".join(f"{label}." for label in reversed(labels))


def suffix_trie(rules: DataFrame) -> SuffixTrie:
    """The rules of the column `rule`, measured before they come to the driver."""
    n, chars = rules.agg(F.count("rule"), F.coalesce(F.sum(F.length("rule")), F.lit(0))).first()
    if n > MOST_RULES or chars > MOST_CHARS:
        raise ValueError(f"{n} suffix rules of {chars} characters are too many")
    return SuffixTrie.of([r["rule"] for r in rules.where("rule is not null").collect()])


def with_domains(
    df: DataFrame, column: str, rules: DataFrame, label: str, suffix: str | None = None, guess: bool = True
) -> DataFrame:
    """Add the label left of the longest public suffix, and on request the suffix.

    Rows stay where they are: every task holds the rules, and each distinct host of a batch
    is looked up once. An address in numbers is its own label. `suffix` is null where no
    rule holds, and for addresses. With `guess` a host without a rule has its last label
    and one that is a suffix, or empty, its raw value; without it both have null. A null
    url has nulls.
    """
    trie = df.sparkSession.sparkContext.broadcast(suffix_trie(rules))

    @F.arrow_udf("struct<label:string,suffix:string>")
    def split(hosts: pa.Array) -> pa.Array:
        coded = hosts.dictionary_encode()
        found = [_split(host, trie.value, guess) for host in coded.dictionary.to_pylist()]
        labels, suffixes = (pa.array([f[i] for f in found], pa.string()).take(coded.indices) for i in (0, 1))
        return pa.StructArray.from_arrays([labels, suffixes], names=["label", "suffix"])

    parts = df.withColumn("_parts", split(host_of(F.col(column))))
    raw = F.when(F.col(column).isNotNull(), F.coalesce("_parts.label", F.col(column) if guess else F.lit(None)))
    if suffix is not None:
        parts = parts.withColumn(suffix, F.col("_parts.suffix"))
    return parts.withColumn(label, raw).drop("_parts")


def _split(host: str, trie: SuffixTrie, guess: bool) -> tuple[str | None, str | None]:
    if _NUMERIC.fullmatch(host):
        return host, None
    labels = host.split(".")
    size = trie.suffix_size(labels)
    suffix = ".".join(labels[len(labels) - size :]) if size else None
    if size >= len(labels) or (not size and not guess):
        return None, suffix
    return labels[len(labels) - size - 1] or None, suffix


def unruled_hosts(df: DataFrame, column: str, rules: DataFrame) -> DataFrame:
    """`host`, `reason` and `n` rows of the hosts whose label is not known for certain.

    The reason is `no host`, `no rule` or `is a suffix`. Null urls are left out.
    """
    known = with_domains(df.where(F.col(column).isNotNull()).select(column), column, rules, "_label", "_suffix", False)
    host = host_of(F.col(column))
    reason = (
        F.when(host == "", "no host").when(F.col("_suffix").isNull(), "no rule").otherwise("is a suffix")
    )
    return (
        known.where(F.col("_label").isNull())
        .groupBy(F.lower(host).alias("host"), reason.alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
    )

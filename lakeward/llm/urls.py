"""URL filters: rules for hosts and paths, then a list of canonical URLs.

A page's verdict is its longest fitting rule's; pages without a rule are looked
up in a list.  The list goes through a blocked Bloom filter: every canonical
URL sets eight bits within one 512-bit block, so a probe touches one row of a
table of at most ``blocks`` rows, which is what makes it safe to broadcast.
Only possible hits are shuffled to the exact hash join with the list, which
removes the filter's false positives.  Everything is DataFrame functions.

Nulls and odd input: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is never listed, so it is allowed.  Repeated pages are
judged alike, an empty list allows all pages without a rule, and other columns
of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Query parameters that name a visit, not a page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        head, slash, tail = self.text.partition("/")
        return slash + tail


#: Fixed by the contract of the registered query.
RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without a closing slash,
    and the query's sorted parameters without those of trackers; no scheme and
    no fragment.  Null for a URL without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    page = F.substring_index(_rest(url), "#", 1)
    at = F.instr(page, "?")
    query = F.when(at > 0, F.substr(page, at + 1)).otherwise(F.lit(""))
    kept = F.sort_array(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), r"/+$", ""), tail))


def bloom_block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    return [
        F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(8)
    ]


def bloom_hit(key: Column) -> Column:
    """Whether all bits of a key are set in the joined block's words."""
    hit = F.lit(True)
    for i, m in enumerate(_masks(key)):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) == m)
    return hit


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of a ``canonical`` column: (block, w0 .. w7), one row per
    block in use, hence never more than ``blocks`` rows of 68 bytes."""
    masks = [m.alias(f"m{i}") for i, m in enumerate(_masks(F.col("canonical")))]
    return (
        listed.select(bloom_block(F.col("canonical"), blocks).alias("block"), *masks)
        .groupBy("block")
        .agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(8)])
    )


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    blocks: int = 1 << 14,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Verdicts (id, host, path, rule, verdict, canonical, listed) for ``pages``.

    ``listed`` has a ``url`` column of URLs to block.  ``blocks`` bounds the
    filter (64 bytes each); a longer list only makes more false positives,
    which the exact join removes."""
    if not 0 < blocks <= 1 << 20:
        raise ValueError("blocks must be 1 to 2**20, or the filter can't be broadcast")
    host, path = F.col("host"), F.col("path")
    fits = {
        r.text: ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in rules
    }
    longest = sorted(rules, key=lambda r: -len(r.text))
    parts = pages.select(
        F.col(id_col),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
        canonical(F.col(url_col)).alias("canonical"),
    )
    ruled = parts.withColumn("rule", F.coalesce(*[F.when(fits[r.text], F.lit(r.text)) for r in longest], F.lit(None)))
    keys = listed.select(canonical(F.col("url")).alias("canonical")).dropna().distinct()
    bloom = bloom_blocks(keys, blocks)  # at most ``blocks`` rows
    hit = bloom_hit(F.col("canonical"))
    probed = (
        ruled.withColumn("block", F.when(F.col("rule").isNull(), bloom_block(F.col("canonical"), blocks)))
        .join(F.broadcast(bloom), "block", "left")
        .withColumn("possible", F.coalesce(hit, F.lit(False)))
        .select(id_col, "host", "path", "canonical", "rule", "possible")
    )
    exact = keys.withColumn("listed", F.lit(True))
    missed = probed.filter(~F.col("possible")).drop("possible").withColumn("listed", F.lit(False))
    found = (
        probed.filter("possible")
        .drop("possible")
        .join(exact, "canonical", "left")
        .withColumn("listed", F.coalesce("listed", F.lit(False)))
    )
    by_rule = F.coalesce(*[F.when(F.col("rule") == r.text, F.lit(r.verdict)) for r in rules], F.lit(None))
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return missed.unionByName(found).select(
        id_col, "host", "path", "rule", F.coalesce(by_rule, by_list).alias("verdict"), "canonical", "listed"
    )

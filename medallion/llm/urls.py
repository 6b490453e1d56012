"""URL filters: rules indexed by their rarest literal token.

A rule's literal tokens are the words of letters and digits that any address it
matches must contain whole. Spark counts how often the tokens of all rules occur in
the addresses of the table, and a rule is filed under its rarest one. The tokens of
an address then fetch the few rules that could match, and only those run their
regular expressions. Rules without such a token run on every address.

Rules come in two kinds. Site rules (``example.net/en/``) fit a host, its subdomains
and paths that start alike; the longest one decides. Pattern rules decide where no
site rule fits: ``*`` stands for anything, ``^`` for a mark or the end, ``|`` anchors
at the start or end of the address and ``||`` at a label of the host; again the longest one
decides, and without one the address is allowed. Of rules of equal length the one
listed first decides.

The index is broadcast. Rules of more than ``BLOCK_BYTES`` together are applied in
blocks of that size, one pass after the other, so its size is bounded.

Defined results: a null URL or one without ``://`` has an empty host and path, which
no site rule fits; repeated rows are judged each on their own; an empty table gives
no rows. Only the id and URL columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import ship, written

TOKEN = "[A-Za-z0-9]+"
#: bytes of rules whose index is broadcast at once
BLOCK_BYTES = 16 << 20


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    text: str
    site: bool = False

    @property
    def regex(self) -> str:
        """Over host and path, written one after the other."""
        if self.site:
            host, slash, path = self.text.partition("/")
            return rf"(?:[^/]*\.)?{re.escape(host)}(?=/|\Z)" + re.escape(slash + path)
        body, start, end = self.text, "", ""
        if body.startswith("||"):
            body, start = body[2:], r"(?:[^/]*\.)?"
        elif body.startswith("|"):
            body = body[1:]
        else:
            start = "(?s:.*?)"
        if body.endswith("|"):
            body, end = body[:-1], r"\Z"
        special = {"*": "(?s:.*?)", "^": r"(?:[^A-Za-z0-9_.%-]|\Z)"}
        return start + "".join(special.get(c) or re.escape(c) for c in body) + end

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that are whole in any address that the rule matches."""
        body = self.text
        whole_start = self.site or body.startswith("|")
        whole_end = False
        if self.site:
            # the host ends at the path or the end of the address
            whole_end = "/" not in body
        else:
            body = body.lstrip("|")
            if body.endswith("|"):
                body, whole_end = body[:-1], True
        found = []
        for match in re.finditer(TOKEN, body):
            left, right = body[: match.start()], body[match.end() :]
            if (whole_start if not left else left[-1] != "*") and (whole_end if not right else right[0] != "*"):
                found.append(match[0])
        return found


def host_and_path(url):
    """(host, path) columns of a URL column."""
    address = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, address, 1), upper, lower), F.regexp_extract(url, address, 2)


def token_counts(addresses: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How often the literal tokens of the rules occur in the addresses (columns host and path)."""
    spark = addresses.sparkSession
    tokens = sorted({t for rule in rules for t in rule.tokens})
    if not tokens:
        return {}
    wanted = spark.createDataFrame([(t,) for t in tokens], "token string")
    found = (
        addresses.select(F.explode(F.regexp_extract_all(F.concat("host", "path"), F.lit(f"({TOKEN})"))).alias("token"))
        .groupBy("token")  # frequent tokens are counted where they are read
        .agg(F.count(F.lit(1)).alias("n"))
        .join(wanted, "token", "left_semi")
    )
    counts = dict.fromkeys(tokens, 0)
    counts.update((r["token"], r["n"]) for r in found.collect())
    return counts


class Index:
    """Rules by their rarest token; ``everywhere`` has those without tokens."""

    def __init__(self, rules: list[tuple[int, Rule]], counts: dict[str, int]):
        self.by_token: dict[str, list[tuple[int, Rule]]] = {}
        self.everywhere: list[tuple[int, Rule]] = []
        for number, rule in rules:
            tokens = rule.tokens
            if tokens:
                rarest = min(tokens, key=lambda t: (counts.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append((number, rule))
            else:
                self.everywhere.append((number, rule))

    def best(self, host: str, path: str, compiled: dict) -> tuple[tuple | None, tuple | None]:
        """The deciding (length, -number) of site rules and of pattern rules that match."""
        address = host + path
        best: list[tuple | None] = [None, None]
        candidates = list(self.everywhere)
        for token in set(_TOKEN.findall(address)):
            candidates += self.by_token.get(token, ())
        for number, rule in candidates:
            rank = (len(rule.text), -number)
            kind = 0 if rule.site else 1
            if best[kind] is not None and rank <= best[kind]:
                continue
            regex = compiled.get(number)
            if regex is None:
                regex = compiled[number] = re.compile(rule.regex)
            if regex.match(address) and (host or not rule.site):
                best[kind] = rank
        return best[0], best[1]


_TOKEN = re.compile(TOKEN)


def _decided(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, compiled = index.value, {}
        for rows in batches:
            best = [
                found.best(host, path, compiled)
                for host, path in zip(rows.column("host").to_pylist(), rows.column("path").to_pylist())
            ]
            columns = {n: rows.column(n) for n in rows.schema.names}
            for kind, name in enumerate(("_site", "_pattern")):
                earlier = columns[name].to_pylist()
                columns[name] = pa.array(
                    [
                        max((tuple(x) for x in (old and (old["length"], old["order"]), new[kind]) if x), default=None)
                        for old, new in zip(earlier, best)
                    ],
                    _RANK,
                )
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


_RANK = pa.struct([("length", pa.int32()), ("order", pa.int32())])


def blocks(rules: list[Rule], limit: int) -> Iterator[list[tuple[int, Rule]]]:
    """The rules with their numbers, cut so that each part has at most ``limit`` bytes of text."""
    part, size = [], 0
    for number, rule in enumerate(rules):
        if part and size + len(rule.text) > limit:
            yield part
            part, size = [], 0
        part.append((number, rule))
        size += len(rule.text)
    yield part


def judge(
    pages: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule`` (site rule or null), ``pattern`` (or null) and ``verdict``."""
    spark = pages.sparkSession
    ship(spark)
    host, path = host_and_path(F.col(url_column))
    rows = pages.select(F.col(id_column).alias("_id"), host.alias("host"), path.alias("path"))
    counts = token_counts(rows, rules)
    rank = "struct<length: int, order: int>"
    found = rows.withColumns({n: F.lit(None).cast(rank) for n in ("_site", "_pattern")})
    schema = T.StructType(
        [T.StructField("_id", pages.schema[id_column].dataType)]
        + T.StructType.fromDDL(f"host string, path string, _site {rank}, _pattern {rank}").fields
    )
    for i, part in enumerate(blocks(rules, block_bytes)):
        if i:  # one index at a time is in memory
            found = written(found, "judged")
        found = found.mapInArrow(_decided(spark.sparkContext.broadcast(Index(part, counts))), schema)
    known = spark.createDataFrame(
        [(-i, r.text, r.action) for i, r in enumerate(rules)], "order int, text string, action string"
    )
    for name in ("site", "pattern"):
        known_as = known.select(
            F.col("order").alias(f"_{name}_order"), F.col("text").alias(f"_{name}_text"),
            F.col("action").alias(f"_{name}_action"),
        )
        found = found.join(known_as, F.col(f"_{name}.order") == F.col(f"_{name}_order"), "left")
    return found.select(
        F.col("_id").alias(id_column), "host", "path", F.col("_site_text").alias("rule"),
        F.col("_pattern_text").alias("pattern"),
        F.coalesce("_site_action", "_pattern_action", F.lit("allow")).alias("verdict"),
    )

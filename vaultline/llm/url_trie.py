"""Allow and block rules for URLs, in a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULE_BYTES = 256 << 20  # of all rule texts together; a larger list belongs into a join
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Node:
    """A host label or a whole path segment. ``ends``: rules that end here, by what they ask of the next segment."""

    below: dict[str, "Node"] = field(default_factory=dict)
    paths: "Node | None" = None
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)

    def child(self, key: str) -> "Node":
        return self.below.setdefault(key, Node())


class RuleTrie:
    """``rules``: pairs of a verdict (allow or block) and a rule, such as ``example.org/en/``.

    A rule holds for its host and all subdomains where the URL's path starts with the rule's path. The
    longest rule text wins; of equally long ones the one with more host labels; of a rule that is both
    allowed and blocked, the block. Host letters A-Z count as a-z.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root, size = Node(), 0
        for verdict, rule in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r} of rule {rule!r}")
            size += len(rule.encode())
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.translate(str.maketrans(UPPER, LOWER)).split(".")):
                node = node.child(label)
            node.paths = node.paths or Node()
            node = node.paths
            *whole, part = (slash + path).split("/")
            for segment in whole:
                node = node.child(segment)
            if node.ends.get(part, ("allow",))[0] == "allow":
                node.ends[part] = (verdict, rule)
        if size > MAX_RULE_BYTES:
            raise ValueError(f"rules of {size} bytes; the trie is sent to every executor")

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best, node = None, self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            at = node.paths
            for segment in segments:
                if at is None:
                    break
                for end in range(len(segment) + 1) if at.ends else ():
                    hit = at.ends.get(segment[:end])
                    if hit and (best is None or len(hit[1]) >= len(best[1])):
                        best = hit
                at = at.below.get(segment)
        return best


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages`` (page_id, url; others are not read).

    host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path: from there
    up to ``?``, ``#`` or the end. A null URL or one without ``://`` has an empty host and path. Without a
    rule that fits (see RuleTrie) the verdict is ``default`` and the rule null. Repeated rows are judged
    each; an empty table gives no rows.
    """
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    def judged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            hits = [trie.value.find(host, path) for host, path in zip(frame["host"], frame["path"])]
            yield frame.assign(
                rule=[hit[1] if hit else None for hit in hits], verdict=[hit[0] if hit else default for hit in hits]
            )

    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(rest, F.lit("")).alias("rest")).select(
        "page_id",
        F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), UPPER, LOWER).alias("host"),
        F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    return parts.mapInPandas(judged, "page_id long, host string, path string, rule string, verdict string")

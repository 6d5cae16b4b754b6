"""URL filter: glob rules packed into multiword Shift-And masks and run all at once over canonical URLs.

A URL becomes ``.host SEPARATOR path`` (host lower-cased, query and fragment left out). Each rule is one glob over
that form; its positions take neighbouring bits of a state that spans as many 64-bit words as the rules need. One
step per character advances every rule of every URL of a batch: ``(state & accepts[c]) << 1 | state & loops``, with
the carry between words. A star is a state that loops to itself. The automaton is built once from the rules and sent
to the tasks; its size depends on the rules alone. Nothing is shuffled.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and gets the default
verdict; repeated rows are judged one by one; an empty table gives an empty result; extra columns pass, a clashing
one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlens.llm.common import lower_ascii, mapped, others, register, slices, table, texts_of

SEPARATOR = 256  # no byte of a URL
CELLS = 1 << 20  # characters of a batch that is stepped through together


@dataclass(frozen=True)
class Rule:
    """Fits a host that matches the glob ``host`` (or any subdomain of it) with a path that matches ``path``."""

    action: str  # allow or block
    host: str
    path: str = "/"
    prefix: bool = True  # the path may go on after the rule's

    @property
    def name(self) -> str:
        return self.host + self.path


SITE_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]
# words in a host that stand for pages nobody wants in a corpus
UNWANTED = ["adult", "bets", "casino", "pills", "poker", "porn", "spam", "track", "viagra", "xxx"]
# hosts that serve adverts and count visits, whole labels and their numbered kin
SERVICES = [
    "ad", "ads", "ad?", "ads?", "adserv*", "adclick*", "adimg*", "adnet*", "banner*", "beacon*", "click?", "clicks", "counter*",
    "metrics", "pixel", "pixel?", "popup*", "sponsor*", "stat?", "stats", "telemetry", "*analytics", "*tagmanager*",
]
# paths of adverts, sessions, carts, scripts and files that hold no page of text
PLACES = [
    "*/ads/*", "*/ad/*", "*/adserver/*", "*/banner?/*", "*/banners/*", "*/sponsored/*", "*/pixel.?*", "*/track?/*", "*/tracking/*", "*/beacon/*",
    "*/login", "*/login/*", "*/login.*", "*/logout*", "*/signin*", "*/signup*", "*/register/*", "*/password/*", "*/cart/*", "*/checkout/*",
    "*/cgi-bin/*", "*/wp-admin/*", "*/wp-login.*", "*/wp-json/*", "*/xmlrpc.*", "*/.git/*", "*/.env", "*/phpmyadmin/*", "*/feed/", "*/rss.xml", "*/sitemap*.xml",
    "*.css", "*.js", "*.json", "*.jp?g", "*.jpg", "*.png", "*.gif", "*.ico", "*.svg", "*.webp", "*.mp?", "*.avi", "*.zip", "*.gz", "*.rar", "*.exe", "*.apk", "*.dmg", "*.iso",
]
HOST_RULES = [Rule("block", f"*{word}*", "") for word in UNWANTED]
SERVICE_RULES = [Rule("block", f"{label}.*", "") for label in SERVICES]
PATH_RULES = [Rule("block", "*", place, prefix=False) for place in PLACES]
METHOD_RULES = [*HOST_RULES, *SERVICE_RULES, *PATH_RULES]


def _symbols(rule: Rule) -> list[object]:
    """The rule as a list of bytes, SEPARATOR, "?" and "*"."""

    def glob(text: str) -> list[object]:
        out: list[object] = []
        for c in text:
            out += [c] if c in "*?" else list(c.encode())
        return out

    return ["*", ord("."), *glob(rule.host), SEPARATOR, *glob(rule.path), *(["*"] if rule.prefix else [])]


class Automaton:
    """Bit masks for a list of rules."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        patterns = []
        for rule in rules:
            steps, loops = [], set()
            for symbol in _symbols(rule):
                if symbol == "*":
                    loops.add(len(steps))
                else:
                    steps.append(symbol)
            patterns.append((steps, loops))
        width = sum(len(steps) + 1 for steps, _ in patterns)
        self.words = max(1, -(-width // 64))
        self.accepts = np.zeros((SEPARATOR + 1, self.words), dtype=np.uint64)
        self.loops = np.zeros(self.words, dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        self.finals: list[tuple[int, int]] = []
        bit = 0
        for steps, loops in patterns:
            self.start[bit // 64] |= np.uint64(1 << bit % 64)
            for k in loops:
                self.loops[(bit + k) // 64] |= np.uint64(1 << (bit + k) % 64)
            for k, symbol in enumerate(steps):
                row = slice(None, SEPARATOR) if symbol == "?" else symbol
                self.accepts[row, (bit + k) // 64] |= np.uint64(1 << (bit + k) % 64)
            bit += len(steps)
            self.finals.append((bit // 64, bit % 64))
            bit += 1

    def _run(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """End states; ``codes`` is a matrix of characters with the longest URLs first."""
        state = np.tile(self.start, (len(codes), 1))
        for k in range(codes.shape[1]):
            n = int(np.searchsorted(-lengths, -k, side="left"))  # URLs longer than k
            now = state[:n]
            moved = now & self.accepts[codes[:n, k]]
            shifted = moved << np.uint64(1)
            shifted[:, 1:] |= moved[:, :-1] >> np.uint64(63)
            state[:n] = shifted | now & self.loops
        return state

    def matches(self, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
        """Rows by rules: which rules each URL fits."""
        lengths = np.array([len(h) + len(p) + 2 for h, p in zip(hosts, paths, strict=True)], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        out = np.zeros((len(hosts), len(self.finals)), dtype=bool)
        start = 0
        while start < len(order):
            longest = int(lengths[order[start]])
            rows = order[start : start + max(1, CELLS // longest)]
            codes = np.zeros((len(rows), longest), dtype=np.uint16)
            for k, r in enumerate(rows.tolist()):
                host, path = hosts[r], paths[r]
                codes[k, 0] = ord(".")
                codes[k, 1 : len(host) + 1] = np.frombuffer(host, dtype=np.uint8)
                codes[k, len(host) + 1] = SEPARATOR
                codes[k, len(host) + 2 : len(host) + 2 + len(path)] = np.frombuffer(path, dtype=np.uint8)
            state = self._run(codes, lengths[rows])
            for j, (word, bit) in enumerate(self.finals):
                out[rows, j] = state[:, word] >> np.uint64(bit) & np.uint64(1)
            start += len(rows)
        return out


def canonical(url: str) -> tuple:
    """Host (A-Z lower-cased) and path columns of a URL column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def judged(pages: DataFrame, rules: Sequence[Rule] = SITE_RULES, method: Sequence[Rule] = METHOD_RULES, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``: the longest fitting rule decides, else any fitting ``method`` rule."""
    ranked = sorted(rules, key=lambda r: -len(r.name))
    automaton = Automaton([*ranked, *method])
    host, path = canonical(url)
    produced = ["host", "path", "rule", "verdict"]
    source = pages.select(*others(pages, produced), host.alias("host"), path.alias("path"))
    schema = T.StructType([*source.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType(), False)])
    n = len(ranked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "path"):
            fits = automaton.matches(texts_of(part.column("host")), texts_of(part.column("path")))
            first = np.where(fits[:, :n].any(axis=1), fits[:, :n].argmax(axis=1) if n else 0, -1).tolist()
            other = fits[:, n:]
            names = [ranked[k].name if k >= 0 else None for k in first]
            picked = np.where(other.any(axis=1), other.argmax(axis=1) if len(method) else 0, -1).tolist()
            verdicts = [ranked[k].action if k >= 0 else method[m].action if m >= 0 else "allow" for k, m in zip(first, picked, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())], schema.names)

    return mapped(source, run, schema)


def _regex(glob: str) -> str:
    """A glob as a regular expression, for the oracle."""
    return "".join({"*": ".*", "?": "."}.get(c, "\\" + c if c in ".+()[]{}|^$" else c) for c in glob)


def _sql_rules(rules: Sequence[Rule]) -> str:
    """Any of the rules, over ``.host path`` with one space between."""
    ends = [rf".*\.{_regex(r.host)} {_regex(r.path)}{'.*' if r.prefix else ''}" for r in rules]
    return "regexp_full_match('.' || host || ' ' || path, '" + "|".join(ends) + "', 's')"


_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN {_sql_rules(METHOD_RULES)} THEN 'block' ELSE 'allow' END AS verdict FROM r"""


@register("op8_url_filters", _SQL)
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("page_id", "host", "path", "rule", "verdict")

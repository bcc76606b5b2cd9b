"""URL filters: a sorted array of rule digests, memory-mapped by the workers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.storage import small_batches, unused_name
from millrace.session import scratch_dir

ALLOW, BLOCK = "allow", "block"
CHUNK = 1 << 20
MAX_LIST_BYTES = 1 << 30


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    def __post_init__(self) -> None:
        if self.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"verdict {self.verdict!r} is neither {ALLOW} nor {BLOCK}")

    @property
    def text(self) -> str:
        return self.host + self.path


def digest_array(rules: Iterable[Rule]) -> bytes:
    """The rules as one block of bytes that can be mapped: digests in order, then the strings they stand for.

    Numbers first: how many rules and shapes there are, the sorted 64-bit digests, where each string starts,
    host length, length in characters and verdict of each rule; the distinct shapes (host and path
    length in bytes) last, so that only such parts of a URL are looked up.
    Of rules with one host and path, blocking wins.
    """
    chosen: dict[tuple[bytes, bytes], str] = {}
    for rule in rules:
        key = (rule.host.translate(LOWER).encode(), rule.path.encode())
        chosen[key] = BLOCK if BLOCK in (rule.verdict, chosen.get(key)) else ALLOW
    entries = sorted((xxhash.xxh64_intdigest(host + path), host, path, verdict)
                     for (host, path), verdict in chosen.items())
    shapes = sorted({(len(host), len(path)) for _, host, path, _ in entries})
    texts = [host + path for _, host, path, _ in entries]
    columns = [
        np.array([len(entries), len(shapes)], "<u8"),
        np.array([digest for digest, _, _, _ in entries], "<u8"),
        np.cumsum([0, *map(len, texts)]).astype("<u8"),
        np.array([len(host) for _, host, _, _ in entries], "<u8"),
        np.array([len(text.decode()) for text in texts], "<u8"),
        np.array([verdict == BLOCK for _, _, _, verdict in entries], "<u8"),
        np.array(shapes, "<u8").reshape(-1)]
    packed = b"".join([*(column.tobytes() for column in columns), *texts])
    if len(packed) > MAX_LIST_BYTES:
        raise ValueError(f"a filter list of {len(packed)} bytes; the driver builds at most {MAX_LIST_BYTES}")
    return packed


# Fixed value: A to Z in lower case, and no other letter.
LOWER = {code: code + 32 for code in range(65, 91)}


class DigestArray:
    """A mapped block of ``digest_array``; only the pages a search touches come into memory."""

    def __init__(self, block: np.ndarray):
        numbers = block[: len(block) // 8 * 8].view("<u8")
        size, shapes = int(numbers[0]), int(numbers[1])
        cuts = np.cumsum([2, size, size + 1, size, size, size, 2 * shapes])
        self.digests, self.starts, self.hosts, self.lengths, self.blocks, flat = (
            numbers[begin:end] for begin, end in zip(cuts[:-1], cuts[1:]))
        self.shapes = [(int(host), int(path)) for host, path in flat.reshape(-1, 2)]
        self.texts = block[int(cuts[-1]) * 8:]

    def text(self, number: int) -> bytes:
        return self.texts[int(self.starts[number]):int(self.starts[number + 1])].tobytes()

    def confirmed(self, probes: list[tuple[int, bytes, bytes]]) -> list[tuple[int, int]]:
        """(row, rule number) of the probes (row, host, path) whose strings are stored.

        All digests are searched at once; where one is found, the stored string decides, and
        with equal digests each of their strings.
        """
        wanted = np.array([xxhash.xxh64_intdigest(host + path) for _, host, path in probes], "<u8")
        low = np.searchsorted(self.digests, wanted, "left")
        high = np.searchsorted(self.digests, wanted, "right")
        hits = []
        for at in np.flatnonzero(low < high):
            row, host, path = probes[at]
            for number in range(int(low[at]), int(high[at])):
                if self.hosts[number] == len(host) and self.text(number) == host + path:
                    hits.append((row, number))
        return hits

    def best(self, hosts: list[str], paths: list[str]) -> list[int]:
        """The longest rule that fits each URL, of equally long ones that with the longer host; -1 if none."""
        probes = []
        for row, (host, path) in enumerate(zip(hosts, paths)):
            host, path = host.encode(), path.encode()
            for host_size, path_size in self.shapes:
                cut = len(host) - host_size
                if path_size <= len(path) and (cut == 0 or cut > 0 and (not host_size or host[cut - 1] == 46)):
                    probes.append((row, host[cut:], path[:path_size]))
        chosen = [-1] * len(hosts)
        for row, number in self.confirmed(probes):
            held = chosen[row]
            if held < 0 or (self.lengths[number], self.hosts[number]) > (self.lengths[held], self.hosts[held]):
                chosen[row] = number
        return chosen


_mapped: dict[str, DigestArray] = {}


def mapped(name: str) -> DigestArray:
    """The array of a file that came with the session, mapped once per worker."""
    if name not in _mapped:
        _mapped[name] = DigestArray(np.memmap(SparkFiles.get(name), np.uint8, "r"))
    return _mapped[name]


def shipped(spark: SparkSession, block: bytes) -> str:
    """Puts a block into the cluster's shared folder and has Spark hand the file to every executor, also later ones."""
    name = f"digests-{uuid.uuid4().hex}.bin"
    path = f"{scratch_dir(spark, 'url-rules')}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        for begin in range(0, len(block), CHUNK):
            out.write(bytearray(block[begin:begin + CHUNK]))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return name


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; empty without."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_verdicts(pages: DataFrame, rules: Iterable[Rule], id_col: str = "page_id", url_col: str = "url",
                 default: str = ALLOW) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, host, path, rule, verdict.

    The longest rule (in characters of host and path) that fits a URL decides; a rule with an empty host fits every host. Where
    none fits, ``rule`` is null and the verdict ``default``: what the list does not name passes. Null URLs and
    those without ``://`` have an empty host and path. Repeated rows and null ids keep a row
    each, an empty table gives an empty result, other columns are not read. The list is built on
    the driver (at most ``MAX_LIST_BYTES``, else an error) and mapped, not loaded, by workers.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    return rows.select(id_col, "host", "path", judged(pages.sparkSession, rules, default).alias("found")) \
        .select(id_col, "host", "path", "found.rule", "found.verdict")


def judged(spark: SparkSession, rules: Iterable[Rule], default: str) -> Column:
    """A struct (rule, verdict) from the columns host and path."""
    small_batches(spark)
    name = shipped(spark, digest_array(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        array = mapped(name)
        best = array.best(list(hosts), list(paths))
        return pd.DataFrame({
            "rule": [None if number < 0 else array.text(number).decode() for number in best],
            "verdict": [default if number < 0 else BLOCK if array.blocks[number] else ALLOW for number in best]})

    return judge("host", "path")


def allowed_pages(pages: DataFrame, rules: Iterable[Rule], url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows of ``pages``, with their columns, whose URL is allowed."""
    whole, host, path = unused_name(), "host", "path"
    url = F.col(url_col).cast("string")
    rows = pages.select(F.struct(*[F.col(f"`{name}`") for name in pages.columns]).alias(whole),
                        host_of(url).alias(host), path_of(url).alias(path))
    verdict = judged(pages.sparkSession, rules, default)["verdict"]
    return rows.where(verdict == ALLOW).select(f"{whole}.*")

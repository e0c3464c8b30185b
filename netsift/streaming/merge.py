"""The merge as a stream: event-time timers over state per domain, by transformWithState.

Spark drops rows older than the watermark before they reach a processor, gives a key's rows of one batch in no order, and
moves the watermark between batches. So rows are sorted by (ts, offset) in the handler, and timers that are due before a
row are carried out before it: rows of one batch are told apart in event time as rows of several are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from netsift.operators.merge import DOMAIN_COLLECTORS, ENTRY_TYPE, IP_COLLECTORS
from netsift.streaming.inputs import with_heartbeat

_ENTRY = "value string, status_code int, error string, at long, offset long"
_ROW = f"struct<{_ENTRY.replace(' ', ':').replace(',:', ', ')}>"
#: What the processor gives; merge_stream() gives the columns of merge_batch() and emitted_at.
_OUT = f"domain string, {', '.join(f'{c} {_ROW}' for c in DOMAIN_COLLECTORS.values())}, dns_ips array<string>, ips map<string, map<string, {_ROW}>>, is_complete boolean, emitted_at long"
MERGED = f"domain string, {', '.join(f'{c} {ENTRY_TYPE}' for c in DOMAIN_COLLECTORS.values())}, dns_ips array<string>, ips map<string, map<string, {ENTRY_TYPE}>>, is_complete boolean, emitted_at long"
SECOND = 1000


class Entry(NamedTuple):
    """A collector's result as state keeps it; at: its time in milliseconds."""

    value: str | None
    status_code: int
    error: str | None
    at: int
    offset: int


def more_useful(old: Entry | None, new: Entry) -> bool:
    """Whether new replaces old: good over bad, then strictly newer."""
    if old is None:
        return True
    if (old.status_code == 0) != (new.status_code == 0):
        return new.status_code == 0
    return new.at > old.at


def dns_info(dns: Entry | None) -> tuple[list[str], bool] | None:
    """Addresses of a DNS result and whether it has any that TLS can be asked of; None if it can't be read."""
    try:
        body = json.loads(dns.value) if dns is not None and dns.value else None
    except ValueError:
        return None
    if not isinstance(body, dict):
        return None
    data = body.get("dnsData") or {}
    some = data.get("A") or data.get("AAAA") or (data.get("CNAME") or {}).get("relatedIPs")
    return list(dict.fromkeys(x["ip"] for x in body.get("ips") or [] if x.get("ip"))), bool(some)


class Rules(NamedTuple):
    """Collectors that an address needs, and times in milliseconds: after a complete result, of a domain's results, of an
    address's results, after the domain's result, and of addresses without a domain."""

    collectors: tuple[str, ...] = IP_COLLECTORS
    grace: int = 5 * SECOND
    domain_life: int = 60 * SECOND
    ip_life: int = 60 * SECOND
    after_domain: int = 10 * SECOND
    ip_wait: int = 60 * SECOND


class Lives:
    """Both lives of one domain: that of its own results and that of its addresses' results.

    Own results: each row may complete them. Complete ones are given at once, again with each row that follows, and are cleared
    by the first clean-up after that; a clean-up is set ``grace`` after each complete result, also those that later lives meet.
    Incomplete ones are given, if zone and dns are there, and cleared when no row came for ``domain_life``.

    Addresses: the first result of the domain fixes the addresses that are waited for and leaves them ``after_domain``, each
    better result of an address leaves ``ip_life``; what is complete is given at once, again with each better result, and
    cleared ``grace`` after the first time. At the end what is there is given, unless there is no domain.
    """

    def __init__(self, rules: Rules):
        self.rules = rules
        self.entries: dict[str, Entry] = {}
        self.done, self.expiry, self.cleanups = False, 0, []
        self.taken: dict[str, Entry] = {}
        self.found: dict[tuple[str, str], Entry] = {}
        self.ip_expiry, self.emitted, self.complete, self.expected = 0, False, False, []
        self.out: list[tuple[dict[str, Entry], dict | None, bool, int]] = []

    def timers(self) -> set[int]:
        return {t for t in (self.expiry, self.ip_expiry, *self.cleanups) if t}

    def domain_row(self, collector: str, entry: Entry) -> None:
        at = entry.at
        if more_useful(self.entries.get(collector), entry):
            self.entries[collector] = entry
        info = dns_info(self.entries.get("dns")) if all(c in self.entries for c in ("zone", "dns", "rdap-dn")) else None
        if info is not None and ("tls" in self.entries or not info[1]):
            self.done, self.expiry = True, 0
            if at + self.rules.grace not in self.cleanups:
                self.cleanups.append(at + self.rules.grace)
            self._result(at, True)
        else:
            self.expiry = (at + self.rules.domain_life) // SECOND * SECOND

    def _result(self, at: int, complete: bool) -> None:
        """The domain's results are given: without addresses they are final, else they go to the address side."""
        ips = (dns_info(self.entries.get("dns")) or ([], False))[0]
        if not ips:
            self.out.append((dict(self.entries), None, complete, at))
        elif not self.taken:
            self.taken, self.complete = dict(self.entries), complete
            self.expected += [ip for ip in ips if ip not in self.expected]
            if self.found:
                self.ip_expiry = 0
            self._extend(at, self.rules.after_domain)
            self._try(at)

    def _extend(self, at: int, by: int) -> None:
        if not self.emitted:
            self.ip_expiry = max(self.ip_expiry, (at + by) // SECOND * SECOND)

    def ip_row(self, ip: str, collector: str, entry: Entry) -> None:
        if collector not in self.rules.collectors or not more_useful(self.found.get((ip, collector)), entry):
            return
        self.found[ip, collector] = entry
        if ip not in self.expected:
            self.expected.append(ip)
        self._extend(entry.at, self.rules.ip_life)
        if self.taken:
            self._try(entry.at)
        else:
            self._extend(entry.at, self.rules.ip_wait)

    def _try(self, at: int) -> None:
        if all((ip, c) in self.found for ip in self.expected for c in self.rules.collectors):
            self._merged(at, self.complete)
            if not self.emitted:
                self.ip_expiry = 0
                self._extend(at, self.rules.grace)
                self.emitted = True

    def _merged(self, at: int, complete: bool) -> None:
        ips = {ip: {c: e for (i, c), e in self.found.items() if i == ip} for ip in self.expected}
        self.out.append((dict(self.taken), ips, complete, at))

    def due(self, upto: int) -> None:
        """Carry out the timers up to a time, in order, the domain's first."""
        while times := [t for t in self.timers() if t <= upto]:
            at = min(times)
            if at == self.expiry or at in self.cleanups:
                expired = at == self.expiry
                self.cleanups = [t for t in self.cleanups if t != at]
                if self.done or expired:
                    if not self.done and "zone" in self.entries and "dns" in self.entries:
                        self._result(at, False)
                    self.entries, self.done, self.expiry = {}, False, 0
            elif at == self.ip_expiry:
                if self.taken and not self.emitted:
                    self._merged(at, False)
                self.found, self.taken, self.expected, self.ip_expiry, self.emitted = {}, {}, [], 0, False


class Merge(StatefulProcessor):
    """Lives of each domain in typed state: results a collector and a pair of address and collector, so that only those that
    changed are written. ``rules``: Rules, or its fields by name."""

    def __init__(self, rules: Rules | None = None, **fields):
        self.rules = rules or Rules(**fields)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.own = handle.getMapState("own", "collector string", _ENTRY)
        self.taken = handle.getMapState("taken", "collector string", _ENTRY)
        self.found = handle.getMapState("found", "ip string, collector string", _ENTRY)
        self.life = handle.getValueState("life", "done boolean, expiry long, cleanups array<long>, ip_expiry long, emitted boolean, complete boolean, expected array<string>, own int, taken int, found int")

    def _load(self) -> Lives:
        lives = Lives(self.rules)
        if self.life.exists():
            done, expiry, cleanups, ip_expiry, emitted, complete, expected, *sizes = self.life.get()
            lives.done, lives.expiry, lives.cleanups = done, expiry, list(cleanups)
            lives.ip_expiry, lives.emitted, lives.complete, lives.expected = ip_expiry, emitted, complete, list(expected)
            if sizes[0]:
                lives.entries = {k[0]: Entry(*v) for k, v in self.own.iterator()}
            if sizes[1]:
                lives.taken = {k[0]: Entry(*v) for k, v in self.taken.iterator()}
            if sizes[2]:
                lives.found = {tuple(k): Entry(*v) for k, v in self.found.iterator()}
        self.before = (dict(lives.entries), dict(lives.taken), dict(lives.found), lives.timers())
        return lives

    def _store(self, lives: Lives) -> None:
        *before, timers = self.before
        now = (lives.entries, lives.taken, lives.found)
        for state, old, new in zip((self.own, self.taken, self.found), before, now):
            if old and not new:
                state.clear()
                continue
            for key in old.keys() - new.keys():
                state.removeKey(key if isinstance(key, tuple) else (key,))
            for key, entry in new.items():
                if old.get(key) is not entry:
                    state.updateValue(key if isinstance(key, tuple) else (key,), tuple(entry))
        for t in timers - lives.timers():
            self.handle.deleteTimer(t)
        for t in lives.timers() - timers:
            self.handle.registerTimer(t)
        if any(now) or lives.timers():
            self.life.update((lives.done, lives.expiry, lives.cleanups, lives.ip_expiry, lives.emitted, lives.complete, lives.expected, *map(len, now)))
        elif any(before) or timers:
            self.life.clear()

    def _rows(self, domain: str, lives: Lives) -> Iterator[Row]:
        for entries, ips, complete, at in lives.out:
            own = {name: tuple(entries[c]) if c in entries else None for c, name in DOMAIN_COLLECTORS.items()}
            info = dns_info(entries.get("dns"))
            maps = None if ips is None else {ip: {c: tuple(e) for c, e in m.items()} for ip, m in ips.items()}
            yield Row(domain=domain, **own, dns_ips=info[0] if info else None, ips=maps, is_complete=complete, emitted_at=at)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        lives = self._load()
        for r in sorted(rows, key=lambda r: (r.at, r.offset)):
            lives.due(r.at - 1)
            entry = Entry(r.value, int(r.status_code), r.error, int(r.at), int(r.offset))
            if isinstance(r.ip, str):
                lives.ip_row(r.ip, r.collector, entry)
            elif r.collector in DOMAIN_COLLECTORS:
                lives.domain_row(r.collector, entry)
        self._store(lives)
        yield from self._rows(key[0], lives)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        lives = self._load()
        # up to the watermark: a timer that is set by another one may be due already
        lives.due(max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()))
        self._store(lives)
        yield from self._rows(key[0], lives)

    def close(self) -> None:
        pass


def _both(domain_results: DataFrame, ip_results: DataFrame) -> DataFrame:
    columns = ["domain", "cast({} as string) as ip", "collector", "value", "status_code", "cast({} as string) as error", "offset", "ts", "unix_millis(ts) as at"]
    pick = lambda df, ip: df.selectExpr(*[c.format("error" if "as error" in c and "error" in df.columns else ip if "as ip" in c else "null") for c in columns])
    return pick(domain_results, "null").unionByName(pick(ip_results, "ip"))


def merge_stream(domain_results: DataFrame, ip_results: DataFrame, out_of_order: str = "1 second", processor: Merge | None = None, idle: str | None = None) -> DataFrame:
    """Merged records (MERGED: the columns of merge_batch() and emitted_at) of two streams of results (domain, collector, value,
    status_code, offset, ts, maybe error; ip for the second one). The session needs the RocksDB state store provider.

    Each input has its own watermark and the query follows the slower one. With ``idle`` (a time like "30 seconds") an input from
    which nothing came for so long follows the clock instead of holding the other back; without it, it does.
    """
    if idle:
        domain_results, ip_results = (with_heartbeat(df, idle) for df in (domain_results, ip_results))
    both = _both(domain_results.withWatermark("ts", out_of_order), ip_results.withWatermark("ts", out_of_order))
    out = both.groupBy("domain").transformWithState(statefulProcessor=processor or Merge(), outputStructType=_OUT, outputMode="append", timeMode="eventTime")
    typed = lambda e: F.when(e.isNotNull(), F.struct(e["value"].alias("value"), e["status_code"].alias("status_code"), e["error"].alias("error"), F.timestamp_millis(e["at"]).alias("ts"), e["offset"].alias("offset")))
    own = {c: typed(F.col(c)) for c in DOMAIN_COLLECTORS.values()}
    return out.withColumns(own | {"ips": F.transform_values("ips", lambda _, m: F.transform_values(m, lambda _, e: typed(e)))})


ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

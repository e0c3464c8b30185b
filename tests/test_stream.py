"""The stream merge, against the cases of its rules."""

import datetime as dt
import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from netsift.operators import merge, stored
from netsift.streaming import merge as sm

NONE, SOME = '{"statusCode":0,"ips":[],"dnsData":{"A":[]}}', '{"statusCode":0,"ips":[{"ip":"1.1.1.1","rrType":"A"}],"dnsData":{"A":["1.1.1.1"]}}'
MAIL = '{"statusCode":0,"ips":[{"ip":"1.1.1.1","rrType":"MX"}],"dnsData":{"A":[],"MX":[{"value":"m","relatedIPs":["1.1.1.1"]}]}}'
BASE = dt.datetime(2024, 1, 1)


SCHEMA = "domain string, ip string, collector string, value string, status_code int, offset long, ts timestamp"


ARROW = pa.schema([("domain", pa.string()), ("ip", pa.string()), ("collector", pa.string()), ("value", pa.string()), ("status_code", pa.int32()), ("offset", pa.int64()), ("ts", pa.timestamp("us", "UTC"))])


def feed(tmp_path, name, rows, first=0):
    """Write rows (domain, ip, collector, value, status, second) as files of one row each."""
    (tmp_path / name).mkdir(exist_ok=True)
    for i, (d, ip, c, v, s, at) in enumerate(rows):
        row = dict(zip(ARROW.names, (d, ip, c, v, s, first + i, BASE.replace(tzinfo=dt.timezone.utc) + dt.timedelta(seconds=at))))
        pq.write_table(pa.Table.from_pylist([row], ARROW), tmp_path / name / f"{first + i}.parquet")


def merge_all(spark, tmp_path):
    """Read what is there and was not read yet, and stop; all results so far in order."""
    for name in ("own", "ips"):
        (tmp_path / name).mkdir(exist_ok=True)
    read = lambda name: spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/{name}")
    rows = sm.merge_stream(read("own"), read("ips"))
    rows.writeStream.option("checkpointLocation", f"file://{tmp_path}/at").trigger(availableNow=True).format("parquet").option("path", f"file://{tmp_path}/out").start().awaitTermination()
    return spark.read.schema(sm.MERGED).parquet(f"file://{tmp_path}/out").where("domain <> 'end'").orderBy("emitted_at").collect()


def times(rows):
    start = int(BASE.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return [(r.domain, r.is_complete, (r.emitted_at - start) / 1000) for r in rows]


# rows far ahead move the watermark past all timers
ENDS = {"own": ("end", None, "zone", "{}", 0, 10_000), "ips": ("end", "9.9.9.9", "rtt", "{}", 0, 10_000)}


def run(spark, tmp_path, own, ips):
    for name, rows in (("own", own), ("ips", ips)):
        feed(tmp_path, name, [*rows, ENDS[name]])
    return merge_all(spark, tmp_path)


def own(*rows):
    return [("d", None, c, v, s, at) for c, v, s, at in rows]


def four(ip, at):
    return [("d", ip, c, "{}", 0, at + i) for i, c in enumerate(("geo-asn", "nerd", "rdap-ip", "rtt"))]


COMPLETE = own(("zone", "{}", 0, 1), ("dns", SOME, 0, 2), ("rdap-dn", "{}", 0, 3), ("tls", "{}", 0, 4))
LATE = own(("zone", "{}", 0, 30), ("dns", SOME, 0, 31), ("rdap-dn", "{}", 0, 32), ("tls", "{}", 0, 33))
CASES = {
    "complete without addresses": (own(("zone", "{}", 0, 1), ("dns", NONE, 0, 2), ("rdap-dn", "{}", 0, 3)), [], [("d", True, 3.0)]),
    "partial": (own(("zone", "{}", 0, 1), ("dns", NONE, 0, 2)), [], [("d", False, 62.0)]),
    "dropped": (own(("rdap-dn", "{}", 0, 1)), [], []),
    "addresses complete": (
        own(("zone", "{}", 0, 1), ("dns", SOME, 0, 2), ("rdap-dn", "{}", 0, 3), ("tls", "{}", 0, 4)),
        [("d", "1.1.1.1", c, "{}", 0, 5 + i) for i, c in enumerate(("geo-asn", "nerd", "rdap-ip", "rtt"))], [("d", True, 8.0)],
    ),
    "addresses without a domain": ([], [("d", "1.1.1.1", "rtt", "{}", 0, 5)], []),
    "after completion, within the grace time": (own(("zone", "{}", 0, 1), ("dns", NONE, 0, 2), ("rdap-dn", "{}", 0, 3), ("dns", NONE, 0, 5)), [], [("d", True, 3.0), ("d", True, 5.0)]),
    "after cleanup a new entry begins": (own(("zone", "{}", 0, 1), ("dns", NONE, 0, 2), ("rdap-dn", "{}", 0, 3), ("dns", NONE, 0, 20)), [], [("d", True, 3.0)]),
    "an extra address has to be complete too": (
        COMPLETE, [*four("1.1.1.1", 5), ("d", "2.2.2.2", "rtt", "{}", 0, 6)], [("d", False, 68.0)],
    ),
    "an extra address that is": (COMPLETE, [*four("1.1.1.1", 5), *four("2.2.2.2", 9)], [("d", True, 8.0), ("d", True, 12.0)]),
    "addresses first": (LATE, four("1.1.1.1", 1), [("d", True, 33.0)]),
    "one collector before the domain": (LATE, [("d", "1.1.1.1", "geo-asn", "{}", 0, 1)], [("d", False, 43.0)]),
    "the state goes five seconds after the first completion": (own(("zone", "{}", 0, 1), ("dns", NONE, 0, 2), ("rdap-dn", "{}", 0, 3), ("dns", NONE, 0, 7), ("dns", NONE, 0, 9)), [], [("d", True, 3.0), ("d", True, 7.0)]),
    "TLS isn't waited for without an address that it can be asked of": (own(("zone", "{}", 0, 1), ("dns", MAIL, 0, 2), ("rdap-dn", "{}", 0, 3)), four("1.1.1.1", 4), [("d", True, 7.0)]),
    "TLS is waited for": (own(("zone", "{}", 0, 1), ("dns", SOME, 0, 2), ("rdap-dn", "{}", 0, 3)), four("1.1.1.1", 4), [("d", False, 63.0)]),
    "a DNS result that can't be read": (own(("zone", "{}", 0, 1), ("dns", "{broken", 0, 2), ("rdap-dn", "{}", 0, 3)), [], [("d", False, 63.0)]),
    "one collector only": (own(("zone", "{}", 0, 1), ("dns", SOME, 0, 2), ("rdap-dn", "{}", 0, 3), ("tls", "{}", 0, 4)), [("d", "1.1.1.1", "geo-asn", "{}", 0, 6)], [("d", False, 66.0)]),
}


@pytest.mark.parametrize("case", CASES)
def test_cases(spark, tmp_path, case):
    domain_rows, ip_rows, wanted = CASES[case]
    assert times(run(spark, tmp_path, domain_rows, ip_rows)) == wanted


@pytest.mark.parametrize("second", [("dns", NONE, 0, 1), ("dns", NONE, 10, 4)])
def test_the_more_useful_result_stays(spark, tmp_path, second):
    """A good result stays if a bad one is newer, whichever comes first."""
    good = ("dns", NONE, 0, 2)
    rows = own(("zone", "{}", 0, 1), *((("dns", NONE, 10, 3), second) if second[3] == 1 else (good, second)), ("rdap-dn", "{}", 0, 5))
    got = run(spark, tmp_path, rows, [])
    assert times(got) == [("d", True, 5.0)] and got[0].dns.status_code == 0


def test_a_restart_goes_on_with_what_was_read(spark, tmp_path):
    feed(tmp_path, "own", own(("zone", "{}", 0, 1), ("dns", NONE, 0, 2)))
    assert merge_all(spark, tmp_path) == []
    feed(tmp_path, "own", [*own(("rdap-dn", "{}", 0, 3)), ENDS["own"]], first=2)
    feed(tmp_path, "ips", [ENDS["ips"]])
    assert times(merge_all(spark, tmp_path)) == [("d", True, 3.0)]
    assert times(merge_all(spark, tmp_path)) == [("d", True, 3.0)]


def test_a_stream_is_written_as_it_comes(spark, tmp_path):
    feed(tmp_path, "own", COMPLETE)
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(f"file://{tmp_path}/own")
    query = stored.write_stream(rows.select("domain", "collector"), f"file://{tmp_path}/written", f"file://{tmp_path}/written-at", every="0 seconds")
    query.processAllAvailable()
    query.stop()
    assert sorted(r.collector for r in spark.read.parquet(f"file://{tmp_path}/written").collect()) == ["dns", "rdap-dn", "tls", "zone"]


# A machine of its own for each of the two steps, fed event by event: rows and timers in the order of time, a domain's timers
# before the addresses', timers before later rows.


class Step:
    def __init__(self):
        self.timers, self.clear = set(), self.fresh
        self.fresh()


class DomainStep(Step):
    def fresh(self):
        self.best, self.ready, self.deadline = {}, False, None

    def row(self, at, kind, good, body):
        old = self.best.get(kind)
        if old is None or (good, at) > (old[0], old[1]) and (good > old[0] or good == old[0] and at > old[1]):
            self.best[kind] = (good, at, body)
        self.timers.discard(self.deadline)
        dns = json.loads(self.best["dns"][2]) if "dns" in self.best else None
        needs_tls = bool(dns and dns.get("dnsData", {}).get("A"))
        if {"zone", "dns", "rdap-dn"} <= self.best.keys() and ("tls" in self.best or not needs_tls):
            self.ready = True
            self.timers.add(at + 5000)
            return dict(self.best), True
        self.deadline = (at + 60_000) // 1000 * 1000
        self.timers.add(self.deadline)

    def timer(self, at):
        if not self.best or not self.ready and at != self.deadline:
            return None
        out = (dict(self.best), False) if not self.ready and {"zone", "dns"} <= self.best.keys() else None
        self.timers.discard(self.deadline)
        self.fresh()
        return out


class AddressStep(Step):
    def fresh(self):
        self.own, self.seen, self.wanted, self.deadline, self.given = None, {}, set(), None, False

    def later(self, at):
        at = at // 1000 * 1000
        if not self.given and (self.deadline is None or self.deadline < at):
            self.deadline = at
            self.timers.add(at)

    def row(self, at, ip, kind, good):
        old = self.seen.get((ip, kind))
        if old and not (good > old[0] or good == old[0] and at > old[1]):
            return None
        self.seen[ip, kind] = (good, at)
        self.wanted.add(ip)
        self.later(at + 60_000)
        return self.try_(at) if self.own else None

    def domain(self, at, best, complete, ips):
        if self.own:
            return None
        self.own = (best, complete)
        self.wanted |= ips
        if self.seen:
            self.deadline = None
        self.later(at + 10_000)
        return self.try_(at)

    def try_(self, at):
        if all((ip, c) in self.seen for ip in self.wanted for c in ("geo-asn", "nerd", "rdap-ip", "rtt")):
            if not self.given:
                self.deadline = None
                self.later(at + 5000)
                self.given = True
            return self.own[0], self.own[1], dict(self.seen), set(self.wanted)

    def timer(self, at):
        if at != self.deadline:
            return None
        out = (self.own[0], False, dict(self.seen), set(self.wanted)) if self.own and not self.given else None
        self.fresh()
        return out


def machine(rows):
    """Results (complete, time, offsets of own results by time, addresses with their collectors) of rows (at, ip or None, kind, good, body)."""
    first, second, out = DomainStep(), AddressStep(), []

    def give(at, got):
        if got:
            best, complete, seen, wanted = got
            out.append((complete, at, {k: v[1] for k, v in best.items()}, {ip: {k: v[1] for (i, k), v in seen.items() if i == ip} for ip in wanted}))

    def from_first(at, got):
        if got:
            best, complete = got
            ips = {x["ip"] for x in json.loads(best["dns"][2]).get("ips") or []}
            if ips:
                give(at, second.domain(at, best, complete, ips))
            else:
                out.append((complete, at, {k: v[1] for k, v in best.items()}, None))

    def until(at):
        while (due := sorted([(t, 0) for t in first.timers if t < at] + [(t, 1) for t in second.timers if t < at])):
            t, which = due[0]
            (second if which else first).timers.discard(t)
            if which:
                give(t, second.timer(t))
            else:
                from_first(t, first.timer(t))

    for at, ip, kind, good, body in rows:
        until(at)
        if ip:
            give(at, second.row(at, ip, kind, good))
        else:
            from_first(at, first.row(at, kind, good, body))
    until(1 << 60)
    return out


def random_rows(rng):
    """Rows of one domain with times in milliseconds, all different."""
    start, n = 1_700_000_000_000 + rng.randrange(30_000), rng.randrange(1, 40)
    times = sorted(rng.sample(range(start, start + rng.choice([8_000, 40_000, 200_000])), n))
    rows = []
    for at in times:
        good = rng.random() < 0.8
        if rng.random() < 0.5:
            kind = rng.choice(["zone", "dns", "rdap-dn", "tls"])
            body = rng.choice([NONE, SOME, SOME, MAIL]) if kind == "dns" and good else "{}"
            rows.append((at, None, kind, good, body))
        else:
            rows.append((at, rng.choice(["1.1.1.1", "1.1.1.1", "2.2.2.2"] if rng.random() < 0.3 else ["1.1.1.1"]), rng.choice(["geo-asn", "nerd", "rdap-ip", "rtt"]), good, "{}"))
    return rows


def test_random_inputs_equal_a_machine(spark, tmp_path):
    """300 domains, their rows shuffled within one batch, and a later batch that moves the watermark past all timers."""
    rng = random.Random(11)
    inputs = {f"x{i}": random_rows(rng) for i in range(300)}
    rows = [(d, ip, c, b, 0 if good else 10, i, dt.datetime.fromtimestamp(at / 1000, dt.timezone.utc)) for d, own_rows in inputs.items() for i, (at, ip, c, good, b) in enumerate(own_rows)]
    rng.shuffle(rows)
    ends = [("end", ip, c, "{}", 0, 0, dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)) for ip, c in ((None, "zone"), ("9.9.9.9", "rtt"))]
    for name, some in (("own", False), ("ips", True)):
        (tmp_path / name).mkdir()
        for i, part in enumerate(([r for r in rows if bool(r[1]) == some], [e for e in ends if bool(e[1]) == some])):
            pq.write_table(pa.Table.from_pylist([dict(zip(ARROW.names, r)) for r in part], ARROW), tmp_path / name / f"{i}.parquet")
    got = {}
    ms = lambda e: round(e.ts.timestamp() * 1000)
    names = {"zone": "zone", "dns": "dns", "rdap": "rdap-dn", "tls": "tls"}
    for r in merge_all(spark, tmp_path):
        ips = None if r.ips is None else {ip: {c: ms(e) for c, e in m.items()} for ip, m in r.ips.items()}
        got.setdefault(r.domain, []).append((r.is_complete, r.emitted_at, {c: ms(r[n]) for n, c in names.items() if r[n]}, ips))
    wanted = {d: machine(own_rows) for d, own_rows in inputs.items()}
    assert sum(map(len, wanted.values())) > 300
    for d in inputs:
        key = lambda x: (x[1], str(x))
        assert sorted(got.get(d, []), key=key) == sorted(wanted[d], key=key), d


def test_lives_of_the_batch_are_those_of_the_stream(spark, tmp_path):
    """Where nothing follows a complete result, the last result of each life of the stream is what the batch gives for it."""
    rng = random.Random(5)
    rows = []
    for i in range(40):
        at = 10
        for _ in range(rng.randrange(1, 4)):
            kinds = rng.sample(["zone", "dns", "rdap-dn"], rng.randrange(1, 4))
            some = rng.random() < 0.5
            for c in kinds:
                at += 1
                rows.append((f"x{i}", None, c, (MAIL if some else NONE) if c == "dns" else "{}", 0, at))
            if some and rng.random() < 0.8:
                for c in rng.sample(["geo-asn", "nerd", "rdap-ip", "rtt"], rng.randrange(1, 5)):
                    at += 1
                    rows.append((f"x{i}", "1.1.1.1", c, "{}", 0, at))
            at += 500
    rows.sort(key=lambda r: r[-1])
    data = [(d, ip, c, b, s, None, i, BASE + dt.timedelta(seconds=at)) for i, (d, ip, c, b, s, at) in enumerate(rows)]
    df = spark.createDataFrame(data, "domain string, ip string, collector string, value string, status_code int, error string, offset long, ts timestamp")
    own_rows, ip_rows = df.where("ip is null").drop("ip"), df.where("ip is not null")
    batch = merge.merge_lives(own_rows, ip_rows, 100)
    for name, part in (("own", own_rows), ("ips", ip_rows)):
        part.coalesce(1).write.parquet(f"file://{tmp_path}/{name}")
        feed(tmp_path, name, [ENDS[name]], first=99)
    last = {(r.domain, r.zone.offset, r.dns.offset): r for r in merge_all(spark, tmp_path)}
    view = lambda r: (r.domain, r.zone.offset, r.dns.offset, r.rdap and r.rdap.offset, r.is_complete, r.ips and {ip: {c: e.offset for c, e in m.items()} for ip, m in r.ips.items()})
    got, wanted = sorted(map(view, batch.collect()), key=str), sorted(map(view, last.values()), key=str)
    assert got == wanted and len({r[0] for r in got}) < len(got)

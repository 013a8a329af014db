"""A scan parses each page in one pass, however many registers and steps read it."""

from collections import Counter

from ledgerloom.operators import scans
from ledgerloom.sources import catalog, parsed, staged

from .test_run import staged_folder, table

FILES = {
    "irdai_life/0-0.html": table("Life One Ltd", "Life Two Ltd"), "irdai_brokers/0-0.html": table("Broker A Ltd"), "irdai_brokers/0-1.html": table("Broker B Ltd"),
    "pfrda_pension_fund/0-0.html": table("Old Pension Fund Ltd", head="Name of the Pension Fund"), "sebi_credit_rating/0-0.html": table("Rating One Ltd", head="Name"), "rbi_release_pages/prid-1.html": table("Released Ltd"),
}


def test_pages_are_parsed_once(spark, tmp_path, monkeypatch):
    seen, parse = str(tmp_path / "seen"), parsed._page

    def counted(content):
        with open(seen, "a") as f:
            f.write(f"{len(content or b'')}\n")
        return parse(content)

    monkeypatch.setattr(parsed, "PAGE", parsed.PAGE._replace(parse=counted))
    got = scans.scan(staged.read_staged(spark, staged_folder(tmp_path / "in", FILES)), catalog.sources(spark))
    names = sorted((r.source_key, r.name) for r in got.names.collect())
    assert names == [("irdai_brokers", "Broker A Ltd"), ("irdai_brokers", "Broker B Ltd"), ("irdai_life", "Life One Ltd"), ("irdai_life", "Life Two Ltd"), ("pfrda_pension_fund", "Old Pension Fund Ltd"), ("sebi_credit_rating", "Rating One Ltd")]
    n = Counter(open(seen).read().split())
    sizes = [len(data) for name, data in FILES.items() if "release" not in name]
    assert sum(n.values()) <= 2 * len(sizes), n  # a checkpoint computes its rows twice

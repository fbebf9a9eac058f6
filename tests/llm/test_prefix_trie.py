"""The prefix trie against a plain one, with blocks of several widths."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from snaplytics.llm import prefix_trie

from .tables import conversations, rows_of, turn_rows

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def tid(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), tid(role, text), role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    below = {}
    for path in sorted(members, key=len, reverse=True):
        kids = [below[k] for k in children[path]]
        saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below[path] = (sum(k[0] for k in kids) or 1, saved + sum(k[1] for k in kids))
    return sorted(((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(children[path]), *below[path],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if built[c] == path).encode()).hexdigest())
                   for path, m in members.items()), key=repr)


@pytest.mark.parametrize("first, later", [(8, 32), (3, 20), (1, 2)])
def test_trie_equals_plain_one(spark, first, later):
    rows = turn_rows() if later > 2 else [r for r in turn_rows() if r[0] is None or r[0] % 7 and r[0] % 9]
    turns = prefix_trie.staged(prefix_trie.ordered_turns(conversations(spark, extra=True, rows=rows)), "test-turns")
    got = prefix_trie.prefix_trie(*prefix_trie.rebuilt_turns(turns), first=first, later=later)
    assert got.columns == COLUMNS
    assert rows_of(got, *COLUMNS) == brute(rows)


def test_ids_of_a_node_are_joined_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    ids = [(5, 2, c) for c in range(-40, 400)] + [(6, 2, 11), (5, 3, 4)]
    got = prefix_trie.ends_digests(spark.createDataFrame(ids, "node long, depth long, conv_id long"))
    def want(n, d):
        return hashlib.sha256(",".join(str(c) for a, b, c in ids if (a, b) == (n, d)).encode()).hexdigest()
    assert rows_of(got, *got.columns) == sorted(((n, d, want(n, d)) for n, d in {(5, 2), (6, 2), (5, 3)}), key=repr)


def test_empty_table(spark):
    turns = prefix_trie.ordered_turns(conversations(spark, rows=[]))
    empty = prefix_trie.prefix_trie(*prefix_trie.rebuilt_turns(turns))
    assert empty.columns == COLUMNS and empty.collect() == []


def test_groupings_of_shorter_conversations_go_before_the_shuffle(spark):
    rows = spark.createDataFrame([(0, b"a", None, 1)], "key long, t1 binary, t2 binary, conv_id long")
    plan = prefix_trie.roll_up(rows, 2, "count(1) AS n")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Filter") > plan.index("Exchange"), plan

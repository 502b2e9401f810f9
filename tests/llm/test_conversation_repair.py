import hashlib
import itertools
import random
import re
import zlib

import pytest

from delivery_marts.llm import conversation_repair as repair
from delivery_marts.llm import queries
from tests.llm.conftest import own_tables

KINDS = "suax"
NO_ROWS = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def every_repair(codes):
    """(cost, audit) of all sequences of edits with up to two insertions in a gap."""
    gaps = ["", "u", "a", "uu", "ua", "au", "aa"]
    for choice in itertools.product(*[("D", "K", "Ru", "Ra")] * len(codes)):
        if any(c != "D" and code % 4 in (repair.BLANK, repair.DUPLICATE) for c, code in zip(choice, codes)):
            continue
        cost = sum({"D": 3, "K": 0}.get(c, 2) for c in choice)
        cost += sum(c != "D" and code % 4 == repair.TRUNCATED for c, code in zip(choice, codes))
        for inserted in itertools.product(gaps, repeat=len(codes) + 1):
            roles, audit = inserted[0], "I" * len(inserted[0])
            for c, code, more in zip(choice, codes, inserted[1:]):
                roles += "" if c == "D" else KINDS[code // 4] if c == "K" else c[1]
                audit += c[0] + "I" * len(more)
                roles += more
            if re.fullmatch("(s?(ua)+)?", roles):
                yield cost + 2 * len("".join(inserted)), audit


def plain_cheapest(codes):
    """The same by pairs (cost, letters), for longer conversations."""
    inf = (10**9, "")
    values = [(0, ""), inf, inf, (0, "")]

    def inserted(values):
        return [min(v, (values[repair.NEXT[s]][0] + 2, "I" + values[repair.NEXT[s]][1])) for s, v in enumerate(values)]

    values = inserted(values)
    for code in reversed(codes):
        kind, fault = divmod(code, 4)
        before = []
        for s, v in enumerate(values):
            options = [(v[0] + 3, "D" + v[1])]
            if fault in (repair.FINE, repair.TRUNCATED):
                extra = int(fault == repair.TRUNCATED)
                after = values[repair.NEXT[s]]
                options.append((after[0] + 2 + extra, "R" + after[1]))
                if kind == repair.WANTED[s]:
                    options.append((after[0] + extra, "K" + after[1]))
                if s == repair.EMPTY and kind == repair.SYSTEM:
                    options.append((values[repair.OPENED][0] + extra, "K" + values[repair.OPENED][1]))
            before.append(min(options))
        values = inserted(before)
    return values[repair.EMPTY]


@pytest.mark.parametrize("turns", [1, 2, 3])
def test_letters_are_those_of_the_best_of_all_repairs(turns):
    rng = random.Random(turns)
    cases = list(itertools.product(range(16), repeat=turns))
    for codes in cases if turns < 3 else rng.sample(cases, 40):
        assert repair.cheapest(bytes(codes)) == min(every_repair(codes)), codes


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_blocks_change_nothing(block):
    rng = random.Random(block)
    for _ in range(150):
        kinds = rng.choice([[0, 1, 2, 3], [1, 2], [1], [2], [0, 2]])
        faults = rng.choice([[0], [0, 3], [0, 1, 2, 3]])
        codes = bytes(4 * rng.choice(kinds) + rng.choice(faults) for _ in range(rng.randrange(0, 40)))
        assert repair.cheapest(codes, block) == plain_cheapest(codes)


def test_a_long_conversation_takes_time_in_proportion():
    codes = bytes([4, 8] * 30_000 + [4] * 5)
    cost, audit = repair.cheapest(codes)
    # Two of the last five change roles, and one turn is inserted.
    assert cost == 3 * 2 and len(audit) == len(codes) + 1 and audit.startswith("KKKK")


def plain_query(rows):
    """The contract on lists of (conv_id, turn, role, text)."""
    wanted = {}
    for conv_id, turn, role, text in rows:
        wanted.setdefault(conv_id, [])
        role, text = (" " if x is None else x for x in (role, text))
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn, "user" if kind == 4 else role, text)
        wanted[conv_id] += [row, row] if kind == 3 else [row]
    out = {}
    for conv_id, turns in wanted.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, codes = set(), []
        for _, role, text in turns:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append(4 * "sua".find(role[:1] or "-") % 16 + fault if role[:1] in "sua" and role else 12 + fault)
        numbers = {t for t, _, _ in turns if t is not None}
        cost, audit = plain_cheapest(codes)
        lines, left, said = [], list(turns), 0
        kinds = [KINDS[c // 4] for c in codes]
        for letter in audit:
            if letter == "I":
                lines.append(f"{'ua'[said % 2]}:".replace("u:", "user:").replace("a:", "assistant:"))
                said += 1
                continue
            (_, role, text), kind = left.pop(0), kinds.pop(0)
            if letter == "D":
                continue
            opens = letter == "K" and kind == "s"
            lines.append(f"{role if letter == 'K' else ('user', 'assistant')[said % 2]}:{text}")
            said += not opens
        pairs = [KINDS[a // 4] + KINDS[b // 4] for a, b in zip(codes, codes[1:])]
        out[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(sum(c % 4 == fault for c in codes) for fault in (1, 2, 3)),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def answer(spark, folder):
    rows = queries.op11_conversation_repair(spark, folder).collect()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_against_the_contract_in_plain_python(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert answer(spark, "/root/testdata/sf0.1") == plain_query(map(tuple, rows))


def test_odd_conversations(spark, tmp_path):
    import pyarrow as pa

    rng = random.Random(5)
    texts = ["Yes.", "no", "", " \t\x0b ", None, "Why?", "a" * 50_000 + "!", "漢字。", "Ends. \n"]
    roles = ["system", "user", "assistant", "tool", "", None, "User", "u"]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(None, t, "user", "x.") for t in (None, 4, None, 2, 9)] + [(100, None, "user", "Hm."), (100, None, "user", "Hm.")]
    rows += [(101, t, rng.choice(roles[:3]), rng.choice(texts[:3])) for t in range(3000)]
    lost = next(c for c in range(200, 10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "gone"))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string()))]
    taken = [pa.array(["taken"] * len(rows))] * 3
    table = pa.table([*columns, *taken], names=["conv_id", "turn", "role", "text", "digest", "audit", "place"])
    got = answer(spark, own_tables(tmp_path, conversations=table))
    assert got == plain_query(rows)
    assert got[lost] == NO_ROWS


def test_repaired_turns_alternate(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Yes"), (1, 2, "user", "More."), (2, 0, "system", "Be.")]
    turns = repair.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = repair.audits(turns)
    got = sorted(map(tuple, repair.repaired(turns, found).collect()))
    # Equal in cost: giving two turns another role is later in ASCII than inserting.
    assert [(r[0], r[2], r[3]) for r in got if r[0] == 2] == []
    roles = "".join(r[3][0] for r in got if r[0] == 1)
    assert re.fullmatch("(s?(ua)+)?", roles) and [r[1] for r in got if r[0] == 1] == list(range(len(roles)))
    assert {r.conv_id: (r.cost, r.audit) for r in found.collect()}[2] == (3, "D")

import random
import re
from collections import Counter

from strandloom.llm.chat import conversations, transcripts

MESSAGES = [
    (1, 0, "user", "How do I bake bread?\nI have  flour."),
    (1, 1, "assistant", "Mix flour and water.\nWait an hour."),
    (1, 2, "user", "On Monday Bob wrote:\n> How do I bake bread?\nMe too"),
    (1, 3, "user", "> mix FLOUR and  water.\n>\n> Wait an hour.\nHow much water?"),
    (1, 4, "assistant", ">> Mix flour and water.\n> How much water?\nA cup.\n"),
    (1, 5, "user", "> nothing anyone said\nhello"),
    (2, 0, "user", "> How do I bake bread?"),
    (2, 1, "user", "a > b"),
    (3, 0, None, None),
    (None, 0, "user", "> x\nlost"),
    (2, 1, "user", "a > b"),
]


def test_links_paths_and_text(spark):
    df = spark.createDataFrame([(*m, "p") for m in MESSAGES], "conv_id long, turn long, role string, text string, parent string")
    got = conversations(df).collect()
    by = {(r.conv_id, r.turn): r for r in got}
    assert len(got) == len(MESSAGES)
    assert [by[1, t].parent_turn for t in range(6)] == [None, None, 0, 1, 3, None]
    assert by[1, 4].reply_path == "000000000001.000000000003.000000000004" and by[1, 4].depth == 3
    assert by[1, 4].text == "A cup." and by[1, 4].n_quoted == 2
    assert by[1, 2].text == "Me too" and by[1, 3].text == "How much water?"
    assert by[2, 0].parent_turn is None and by[2, 0].text == "" and by[2, 1].text == "a > b"
    assert by[3, 0].text == "" and by[None, 0].reply_path == "-"
    order = [(r.turn) for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.reply_path)]
    assert order == [0, 2, 1, 3, 4, 5]


def test_long_chain(spark):
    rows = [(7, 0, "user", "line 0")] + [(7, i, "user", f"> line {i - 1}\nline {i}") for i in range(1, 40)]
    got = {r.turn: r for r in conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[39].depth == 40 and got[39].reply_path.split(".")[0] == "0" * 12


def brute(rows):
    """(conv, turn) to parent, by comparing word lists; messages of one place count together."""

    def parts(text):
        runs, lines = [], (text or "").split("\n")
        for i, line in enumerate(lines):
            m = re.match(r"(?:[ \t]*>)+", line)
            if not m and i + 1 < len(lines) and re.match(r"[ \t]*>", lines[i + 1]) and re.search(r"([0-9@]|wrote|writes|said|schrieb|a écrit|escribió).*:[ \t\r]*$", line):
                continue
            level = m[0].count(">") if m else 0
            if not runs or runs[-1][0] != level:
                runs.append([level, []])
            runs[-1][1].append(line[len(m[0]) :] if m else line)
        for level, run in runs:
            whole = "\n".join(run).lower()
            w = whole.split()
            got = Counter(tuple(w[i : i + 6]) for i in range(len(w) - 5))
            short = {tuple(x.split()) for x in [*run, *re.split(r"(?<=[.!?])[ \t]+|\n", "\n".join(run))]} | {tuple("\n".join(run).split())}
            got.update({tuple(y.lower() for y in x): 1 for x in short if 0 < len(x) < 6})
            yield level, got

    held = {}
    for conv, turn, _, text in rows:
        for level, got in parts(text):
            held.setdefault((conv, turn, level), Counter()).update(got)
    out = {}
    for conv, turn, _, _ in rows:
        best = None
        for level in sorted(k[2] for k in held if k[:2] == (conv, turn) and k[2] > 0):
            votes = Counter()
            for unit, n in held[conv, turn, level].items():
                source = max((t for c, t, v in held if c == conv and v == 0 and t < turn and unit in held[c, t, v]), default=None)
                if source is not None:
                    votes[source] += n
            if votes:
                best = max(votes, key=lambda s: (votes[s], s))
                break
        out[conv, turn] = best
    return out


def mail(seed):
    """Threads whose replies quote whole or part of earlier messages, nested, at other line widths."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]

    def wrap(text, width):
        w = text.split()
        return [" ".join(w[i : i + width]) for i in range(0, len(w), width)] or [""]

    rows = []
    for conv in range(6):
        bodies = []
        for turn in range(12):
            own = " ".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))).capitalize() + rng.choice(".!?") for _ in range(rng.randint(1, 4)))
            text = "\n".join(wrap(own, 7))
            if bodies and rng.random() < 0.7:
                source = rng.choice(bodies)
                w = source.split()
                lo = rng.randrange(len(w))
                quote = [f"{rng.choice(['> ', '>'])}{x}" for x in wrap(" ".join(w[lo : lo + rng.randint(3, 30)]), rng.randint(3, 9))]
                if rng.random() < 0.4:
                    quote = [f">> {x}" for x in wrap(rng.choice(bodies), 5)] + quote
                text = "\n".join((["On 3 May x@y wrote:"] if rng.random() < 0.5 else []) + quote) + "\n" + text
            bodies.append(own)
            rows.append((conv, turn, "user", text))
    return rows


def test_links_against_brute_force(spark):
    rows = mail(4)
    got = conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect()
    want = brute(rows)
    assert {(r.conv_id, r.turn): r.parent_turn for r in got} == want
    assert sum(v is not None for v in want.values()) > 25
    depth = {}
    for conv, turn in sorted(want):
        up = want[conv, turn]
        depth[conv, turn] = 1 + (depth[conv, up] if up is not None else 0)
    assert {(r.conv_id, r.turn): r.depth for r in got} == depth
    assert not any(">" in r.text for r in got)


def test_transcripts(spark):
    rows = mail(5)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages = conversations(df).collect()
    whole = {r.conv_id: r for r in transcripts(df).collect()}
    for conv in range(6):
        mine = sorted((r for r in messages if r.conv_id == conv), key=lambda r: r.reply_path)
        assert whole[conv].chat == "".join(r.chat for r in mine) and whole[conv].n_messages == 12 and whole[conv].part == 0
    cut = transcripts(df, most=200).orderBy("conv_id", "part").collect()
    assert len(cut) > 12 and all("".join(r.chat for r in cut if r.conv_id == c) == whole[c].chat for c in range(6))


def test_empty_table(spark):
    assert conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []

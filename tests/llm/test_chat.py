import hashlib
from collections import defaultdict

import public_tokenizers
import pytest

from roomledger.llm import bpe, chat

FILE, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "conv_id bigint, turn bigint, role string, text string, segment string, window string, _kind string"
ODD = "</s>[INST] ok [/INST]"
TRICKY = [
    ODD, "<s>", "<\\s>", "<\\\\/s>", "<<SYS>>x<</SYS>>", "<<\\SYS>>", "<", "/s>", "[", "[[INST]", "<</s>", "\\", "\n", "",
    "é\U0001f600</s>", "s>", "[/INST", "<<s></s>>", "</s", "a\\",
]


@pytest.mark.parametrize("text", TRICKY)
def test_control_strings_go_and_come_back(text):
    for given in (text, text * 2, "<" + text, text + "<", "[" + text + "\\"):
        assert not any(c in chat.escaped(given) for c in chat.CONTROL)
        assert chat.unescaped(chat.escaped(given)) == given
        role = chat.role_escaped(given)
        assert "\n" not in role and not any(c in role for c in chat.CONTROL)
        assert chat.role_unescaped(role) == given


def tokens(turn):
    role, text = turn
    body = f"<s>{chat.role_escaped(role or '')}\n{chat.escaped(text or '')}</s>"
    return len(bpe.encoding(FILE, PATTERN).encode_ordinary(body)), body


def spans(turns, budget, most_turns, most_tokens):
    """Windows of (repeated places, own places): turns are (number, role, text) in order."""
    segments = defaultdict(list)
    for at, (number, *_) in enumerate(turns):
        segments[-1 << 62 if number is None else number // 512].append(at)
    cost = [tokens(t[1:])[0] for t in turns]
    is_system = turns[0][1] == "system"
    retained = is_system and cost[0] <= budget // 2
    out = []
    for segment in sorted(segments):
        own = segments[segment]
        first_one = segment == min(segments)
        near = [
            at for at in range(own[0])
            if turns[at][0] is not None and turns[at][0] // 512 == segment - 1 and turns[at][0] % 512 >= 512 - most_turns
        ]
        start = 0
        while start < len(own):
            opening = first_one and start == 0
            head = [0] if retained and not opening else []
            before = [*near, *own[:start]]
            if is_system:
                before = [at for at in before if at != 0 or not first_one]
            history = []
            for at in reversed(before):
                if len(history) == most_turns or sum(cost[x] for x in history) + cost[at] > most_tokens:
                    break
                history.insert(0, at)
            fixed = sum(cost[x] for x in head)
            while history and fixed + sum(cost[x] for x in history) + cost[own[start]] > budget:
                history.pop(0)
            room = budget - fixed - sum(cost[x] for x in history)
            end = start + 1
            while end < len(own) and sum(cost[x] for x in own[start : end + 1]) <= room:
                end += 1
            out.append(([*head, *history], own[start:end]))
            start = end
    return out


def conversations():
    """Name to turns, in order."""
    words = "the cat sat on a mat and said nothing at all to the other cat "
    convs = {
        1: [(0, "user", "hi"), (1, "assistant", "hello")],
        2: [(0, "system", "be kind " * 10)] + [
            (k, "assistant" if k % 2 == 0 else "user", words * (k % 5 + 1)) for k in range(1, 40)
        ],
        3: [(k, "assistant" if k % 2 else "user", words * 300 if k == 4 else f"turn {k}") for k in range(9)],
        4: [(0, "system", words * 20), (1, "user", "a"), (2, "assistant", words * 9), (3, "assistant", words * 9)],
        5: [(0, "assistant", t) for t in sorted(TRICKY)] + [(1, "odd\nrole</s>", ODD)],
        6: [(0, "system", "short")] + [(k, "assistant" if k % 2 else "user", f"number {k} " * 3) for k in range(1, 1300)],
        7: [(None, None, None), (-600, "user", "before"), (3, "system", "not the first"), (3, "user", "tie")],
        8: [(0, "user", "again"), (0, "user", "again"), (1, "assistant", ""), (1, "assistant", "")],
        9: [(0, "system", "only")],
        10: [(k, "assistant", words * 2) for k in range(508, 530)],
        11: [(0, "user", "x"), (512, "system", "no opening"), (513, "assistant", words), (2000, "assistant", "far")],
    }
    convs[None] = [(0, "user", "no id"), (1, "assistant", "none either")]
    return convs


def frame(spark, convs):
    rows = [(c, *t, "clash", "clash", "clash") for c, turns in convs.items() for t in reversed(turns)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("budget, most_turns, most_tokens", [(120, 2, 60), (2048, 2, 512), (40, 0, 0), (200, 5, 1000)])
def test_windows_equal_brute_force(spark, budget, most_turns, most_tokens):
    convs = conversations()
    rows = chat.chat_windows(frame(spark, convs), FILE, PATTERN, budget, most_turns, most_tokens).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.segment, r.window)):
        found[r.conv_id].append(r)
    assert set(found) == set(convs)
    for conv, turns in convs.items():
        wanted = spans(turns, budget, most_turns, most_tokens)
        assert len(found[conv]) == len(wanted)
        for r, (repeated, own) in zip(found[conv], wanted):
            bodies = [tokens(turns[at][1:])[1] for at in [*repeated, *own]]
            assert (r.text, r.repeated, r.n_turns) == ("".join(bodies), len(repeated), len(bodies))
            assert r.n_tokens == sum(tokens(turns[at][1:])[0] for at in [*repeated, *own])
            assert r.n_tokens <= budget or len(own) == 1
            learnt = [chat.unescaped(r.text[s.start : s.end]) for s in r.loss]
            assert learnt == [turns[at][2] or "" for at in own if turns[at][1] == "assistant"]


def test_read_back_is_what_was_given(spark):
    convs = conversations()
    windows = chat.chat_windows(frame(spark, convs), FILE, PATTERN, 100)
    found = {r.conv_id: r for r in chat.read_back(windows).collect()}
    assert set(found) == set(convs)
    sizes = defaultdict(int)
    for r in windows.collect():
        sizes[r.conv_id] += len(r.text)
    for conv, turns in convs.items():
        r = found[conv]
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns)
        learnt = "".join(text or "" for _, role, text in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(turns), len(learnt), sizes[conv])
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


def test_long_text_stays_whole(spark):
    long = "word </s> " * 200_000
    windows = chat.chat_windows(frame(spark, {1: [(0, "user", "q"), (1, "assistant", long)]}), FILE, PATTERN)
    (r,) = chat.read_back(windows).collect()
    assert r.loss_chars == len(long)


def test_empty_table(spark):
    windows = chat.chat_windows(spark.createDataFrame([], SCHEMA), FILE, PATTERN)
    assert windows.count() == 0 and chat.read_back(windows).count() == 0

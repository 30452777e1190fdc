import random
import string

from waymark.llm import quality


def test_noise_repeated_blocks_and_tails_are_rejected(documents):
    r = random.Random(4)
    syllable = lambda: r.choice("bcdfghklmnprstvz") + r.choice("aeiou")
    lexicon = ["".join(syllable() for _ in range(r.randint(1, 4))) for _ in range(600)]
    prose = lambda n: " ".join(r.choice(lexicon) for _ in range(n))
    noise = lambda a, n: " ".join("".join(r.choice(a) for _ in range(r.randint(3, 9))) for _ in range(n))
    block = (prose(90) + " ") * 9
    texts = [prose(3000), noise(string.ascii_letters + string.digits, 130), noise(string.ascii_letters + string.digits, 1200), noise(string.ascii_lowercase, 1200), prose(2000) + " " + noise(string.ascii_letters, 200), prose(1500) + " " + block[:4200] + prose(1500)]
    got = {x.doc_id: (x.kept, x.base_failed) for x in quality.quality_signals(documents(texts)).collect()}
    assert got == {0: (True, False)} | {k: (False, False) for k in range(1, 6)}

"""Wrapped FASTQ records against a plain reader."""

import random

from strandframe.sources import reads as R


def plain(text, least):
    lines, out, rid = iter(text.split("\n")), [], 0
    for head in lines:
        if not head.startswith("@"):
            continue
        seq, qual = "", ""
        for line in lines:
            if line.startswith("+"):
                break
            seq += line.strip(" ")
        while len(qual) < len(seq):
            line = next(lines, None)
            if line is None:
                break
            qual += line
        if len(seq) >= least:
            out.append((rid, head[1:], seq, qual))
        rid += 1
    return out


def test_wrapped(spark, tmp_path):
    rnd = random.Random(2)
    files = {}
    for k in range(4):
        text = "" if k else "some words\n+\n"
        for i in range(rnd.choice([1, 40, 200])):
            n = rnd.choice([0, 1, 7, 30, 90])
            seq, qual = "".join(rnd.choices("ACGT", k=n)), "".join(rnd.choices("@+IA!", k=n))
            w, v = rnd.randint(1, 30), rnd.randint(1, 30)
            wrapped = "".join(seq[a : a + w] + "\n" for a in range(0, n, w))
            text += f"@r{k}.{i} x\n{wrapped}+{rnd.choice(['', 'r'])}\n" + "".join(qual[a : a + v] + "\n" for a in range(0, n, v)) + rnd.choice(["", "\n", "noise\n"])
        files[f"f{k}.fq"] = text
    files["cut.fq"] = "@a\nACGT\n+\nII"
    files["open.fq"] = "@a\nACGT\nAC"
    files["none.fq"] = "x\n"
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = R.normalize_fastq(spark, str(tmp_path), 1).collect()
    for name, text in files.items():
        own = sorted((r["rid"], r["id"], r["seq"], r["qual"]) for r in got if r["file"].endswith("/" + name))
        assert own == plain(text.removesuffix("\n"), 1), name


def test_records_across_buckets(spark, tmp_path):
    """Records that run over several buckets of lines, with headers, plus lines and ends in different ones."""
    rnd = random.Random(3)
    text = ""
    for i in range(60):
        n = rnd.choice([0, 3, 12, 40])
        seq, qual = "".join(rnd.choices("ACGT", k=n)), "".join(rnd.choices("@+IA", k=n))
        w, v = rnd.randint(1, 9), rnd.randint(1, 9)
        text += f"@r{i}\n" + "".join(seq[a : a + w] + "\n" for a in range(0, n, w)) + "+\n" + "".join(qual[a : a + v] + "\n" for a in range(0, n, v)) + rnd.choice(["", "\n", "@\n"])
    (tmp_path / "a.fq").write_text(text)
    (tmp_path / "b.fq").write_text("@a\n" + "AC\n" * 20 + "+\n" + "@I\n" * 3)
    for width in (4, 1 << 14):
        got = R.normalize_fastq(spark, str(tmp_path), 0, width).collect()
        for name in ("a.fq", "b.fq"):
            own = sorted((r["rid"], r["id"], r["seq"], r["qual"]) for r in got if r["file"].endswith("/" + name))
            assert own == plain((tmp_path / name).read_text().removesuffix("\n"), 0), (width, name)

"""The command line runs a program end to end in its own process."""

import glob
import gzip
import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    env = dict(os.environ, PYTHONPATH=REPO)
    return subprocess.run([sys.executable, "-m", "ravel", *args], cwd=REPO, env=env,
                          capture_output=True, text=True, timeout=600)


def test_words_and_phones(tmp):
    with open(f"{tmp}/in.txt", "w") as f:
        f.write("x a\ny a\ny a\nb\n")
    r = run("words", f"{tmp}/in.txt", f"{tmp}/words")
    assert r.returncode == 0, r.stderr[-2000:]
    data = b"".join(open(p, "rb").read() for p in sorted(glob.glob(f"{tmp}/words/part-*")))
    assert data.startswith(b"a:3\r\n\ty:2\r\n\tx:1\r\n")

    rec = ("WARC/1.0\r\nWARC-Target-URI: http://a.nl/\r\nContent-Length: 12\r\n\r\n"
           "+31612345678\r\n\r\n").encode()
    with open(f"{tmp}/s.wet.gz", "wb") as f:
        f.write(gzip.compress(rec))
    with open(f"{tmp}/index.txt", "w") as f:
        f.write(f"file:{tmp}/s.wet.gz\nfile:{tmp}/missing.gz\n")
    r = run("phones", "--input", f"{tmp}/index.txt", "--output", f"{tmp}/phones")
    assert r.returncode == 0, r.stderr[-2000:]
    counters = json.loads(r.stdout.strip().splitlines()[-1])
    assert counters == {"failed_segments": 1, "failed_parses": 0}

"""Main text of web pages: a bidirectional LSTM labels every block in the context of its page."""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.llm.common import hash_sample, pieces, table
from lakebank.llm.neardup import WordHashes

#: Bounds of the training sample: pages, and blocks of each. Width of the hashed vectors and of the recurrent state.
SAMPLE_PAGES, SAMPLE_BLOCKS = 400, 120
PATH, WORDS, NUMBERS, STATE = 96, 32, 6, 16

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title|iframe)(?=[\s/>]|\Z)[^>]*+(?:>|\Z).*?(?:</\1\s*+>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^'">])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S | re.I)
#: Elements left out with all they hold, if they end at all; of the others above a page can't show what follows.
_SKIPPED = {name: re.compile(rf"</{name}\s*+>", re.I) for name in ("noscript", "template", "svg", "select", "object")}
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_VOID = frozenset("br hr img input meta link wbr source area base col embed param track".split())
_BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header html hr label legend li main menu nav ol p pre section summary table tbody td tfoot th thead
tr ul""".split())
#: A new element of this kind ends an open one of these, up to the nearest of the others.
_ENDS = {"p": ({"p"}, _BLOCK - {"p"}), "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"})}


class Path:
    """Names of the open elements, outermost first, as a link to those of the element around it: deep pages stay linear in memory."""

    __slots__ = ("up", "names", "size", "held")

    def __init__(self, up: Path | None = None, names: tuple[str, ...] = ()):
        self.up, self.names, self.held = up, names, None
        self.size = len(names) + (up.size if up else 0)

    def _chain(self) -> list[Path]:
        node, out = self, []
        while node is not None:
            out.append(node)
            node = node.up
        return out[::-1]

    def __iter__(self):
        return (name for node in self._chain() for name in node.names)

    def __len__(self) -> int:
        return self.size

    def __eq__(self, other) -> bool:
        return tuple(self) == tuple(other)

    def vector(self, hashes: WordHashes):
        """Hashed names, each path's from that of the element around it."""
        import numpy as np

        todo, node = [], self
        while node is not None and node.held is None:
            todo.append(node)
            node = node.up
        vector = node.held if node else np.zeros(PATH, np.float32)
        for node in reversed(todo):
            vector = vector.copy()
            for name in node.names:
                h = hashes[name.encode()]
                vector[h % PATH] += 1.0 if h >> 40 & 1 else -1.0
            node.held = vector
        return vector


def blocks(page: str | None) -> list[tuple[str, Path, float]]:
    """(text, tag path, share of linked characters) of the leaf blocks in page order.

    Comments and elements that hold no text of the page (scripts, styles, ...)
    are left out, some of them only if they have an end tag; block elements
    part the text, all others only mark it up.
    Unclosed and misnested tags, and a page that breaks off in one, are taken
    as far as they go.
    """
    out: list = []
    stack: list[tuple[str, Path]] = []
    opened: Counter = Counter()
    root = Path()
    text: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        words = " ".join(html.unescape("".join(text)).split())
        if words:
            out.append((words, stack[-1][1] if stack else root, min(1.0, linked / len(words))))
        text.clear()
        linked = 0

    def close(at: int):
        opened.subtract(name for name, _ in stack[at:])
        del stack[at:]

    page = page or ""
    at = 0
    endless = set()
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            part = page[at:m.start()]
            text.append(part)
            if opened["a"]:
                linked += len(part)
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in _SKIPPED and not m[2] and name not in endless and not (name == "svg" and m[4].endswith("/")):
            if end := _SKIPPED[name].search(page, at):
                at = end.end()
                continue
            endless.add(name)   # none further on either: each name is searched for in vain once
        if name == "br":
            text.append(" ")
        if name in _BLOCK:
            flush()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[i][0] == name:
                    close(i)
                    break
                if name not in _BLOCK and stack[i][0] in _BLOCK:
                    break   # an inline end tag does not reach out of its block
            continue
        if name in _VOID:
            continue
        if name in _ENDS:
            ends, stops = _ENDS[name]
            for i in range(len(stack) - 1, -1, -1) if any(opened[e] for e in ends) else ():
                if stack[i][0] in ends:
                    close(i)
                    break
                if stack[i][0] in stops:
                    break
        names = [name]
        if name in _BLOCK or name == "span":
            for kind, *values in _NAMES.findall(m[4] or ""):
                names += [f"{kind.lower()}={w}" for w in re.split(r"[\s_-]+", "".join(values).lower()) if w]
        if name in _BLOCK or name == "a" or len(names) > 1:
            stack.append((name, Path(stack[-1][1] if stack else root, tuple(names))))
            opened[name] += 1
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


def features(page_blocks: list, hashes: WordHashes):
    """One row per block: hashed tag path, hashed words, and a few numbers."""
    import numpy as np

    n = len(page_blocks)
    x = np.zeros((n, PATH + WORDS + NUMBERS), np.float32)
    for i, (text, path, linked) in enumerate(page_blocks):
        x[i, :PATH] = path.vector(hashes)
        words = text.encode().split()
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        sign = np.where(h >> np.uint64(41) & np.uint64(1), 1.0, -1.0)
        bag = np.bincount((h % np.uint64(WORDS)).astype(np.int64), sign, WORDS)
        x[i, PATH:PATH + WORDS] = bag / max(1.0, 2 * np.linalg.norm(bag))   # short, however often a word repeats
        x[i, PATH + WORDS:] = (np.log1p(len(words)) / 5, linked, text[-1] in ".!?", i / n, min(n, 100) / 100, len(path) / 10)
    np.clip(x, -3, 3, out=x)
    return x


class BiLstm:
    """Bidirectional LSTM and a logistic output per step, in numpy, with its gradients."""

    def __init__(self, inputs: int, state: int = STATE, seed: int = 7):
        import numpy as np

        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / shape[0] ** 0.5).astype(np.float32)
        self.state = state
        self.p = {}
        for d in "fb":
            self.p |= {f"W{d}": draw(inputs, 4 * state), f"U{d}": draw(state, 4 * state), f"c{d}": np.zeros(4 * state, np.float32)}
            self.p[f"c{d}"][state:2 * state] = 1   # forget gates begin open
        self.p |= {"w": draw(2 * state), "c": np.zeros(1, np.float32)}

    def _run(self, x, d: str):
        import numpy as np

        n, t, _ = x.shape
        s = self.state
        into = x @ self.p[f"W{d}"] + self.p[f"c{d}"]
        gates = np.empty((n, t, 4 * s), np.float32)
        cell, out = np.zeros((n, t + 1, s), np.float32), np.zeros((n, t + 1, s), np.float32)
        for i in range(t):
            z = into[:, i] + out[:, i] @ self.p[f"U{d}"]
            gates[:, i, :3 * s] = 1 / (1 + np.exp(-np.clip(z[:, :3 * s], -30, 30)))
            gates[:, i, 3 * s:] = np.tanh(z[:, 3 * s:])
            g = gates[:, i]
            cell[:, i + 1] = g[:, s:2 * s] * cell[:, i] + g[:, :s] * g[:, 3 * s:]
            out[:, i + 1] = g[:, 2 * s:3 * s] * np.tanh(cell[:, i + 1])
        return out, (x, gates, cell, out)

    def _back(self, grad, memory, d: str) -> dict:
        import numpy as np

        x, gates, cell, out = memory
        n, t, _ = x.shape
        s = self.state
        dz = np.empty((n, t, 4 * s), np.float32)
        dh, dc = np.zeros((n, s), np.float32), np.zeros((n, s), np.float32)
        for i in range(t - 1, -1, -1):
            a, f, o, g = (gates[:, i, k * s:(k + 1) * s] for k in range(4))
            dh = dh + grad[:, i]
            th = np.tanh(cell[:, i + 1])
            dc = dc + dh * o * (1 - th * th)
            dz[:, i] = np.concatenate([dc * g * a * (1 - a), dc * cell[:, i] * f * (1 - f), dh * th * o * (1 - o), dc * a * (1 - g * g)], 1)
            dc = dc * f
            dh = dz[:, i] @ self.p[f"U{d}"].T
        flat = dz.reshape(-1, 4 * s)
        return {f"W{d}": x.reshape(-1, x.shape[2]).T @ flat, f"U{d}": out[:, :-1].reshape(-1, s).T @ flat, f"c{d}": flat.sum(0)}

    @staticmethod
    def _turn(lens, t: int):
        """Index that reverses each sequence within its own length."""
        import numpy as np

        at = np.arange(t)
        return np.where(at < lens[:, None], lens[:, None] - 1 - at, at)

    def scores(self, x, lens, keep: bool = False):
        import numpy as np

        turn = self._turn(lens, x.shape[1])[:, :, None]
        f, fm = self._run(x, "f")
        b, bm = self._run(np.take_along_axis(x, turn, 1), "b")
        both = np.concatenate([f[:, 1:], np.take_along_axis(b[:, 1:], turn, 1)], 2)
        z = both @ self.p["w"] + self.p["c"]
        return (z, both, fm, bm, turn) if keep else z

    def gradients(self, x, lens, y) -> dict:
        import numpy as np

        z, both, fm, bm, turn = self.scores(x, lens, keep=True)
        mask = np.arange(x.shape[1]) < lens[:, None]
        dz = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * mask / mask.sum()).astype(np.float32)
        dh = dz[:, :, None] * self.p["w"]
        s = self.state
        return {"w": np.einsum("ntk,nt->k", both, dz), "c": dz.sum(keepdims=True)[0],
                **self._back(dh[:, :, :s], fm, "f"), **self._back(np.take_along_axis(dh[:, :, s:], turn, 1), bm, "b")}

    def fit(self, samples: list, rounds: int = 16, batch: int = 32, rate: float = 0.01, seed: int = 7):
        """Adam over padded batches of (features, labels); at random a block's path
        or a page's words are hidden, so that neighbours count too and no wording decides alone."""
        import numpy as np

        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step, steps = 0, rounds * -(-len(samples) // batch)
        for _ in range(rounds):
            order = rng.permutation(len(samples))
            for start in range(0, len(order), batch):
                part = [samples[i] for i in order[start:start + batch]]
                x, lens = padded([f for f, _ in part])
                y = np.zeros(x.shape[:2], np.float32)
                for i, (_, labels) in enumerate(part):
                    y[i, :len(labels)] = labels
                x[:, :, :PATH] *= rng.random(x.shape[:2])[:, :, None] > 0.03
                x[:, :, PATH:PATH + WORDS] *= rng.random(len(x))[:, None, None] > 0.5
                step += 1
                for k, g in self.gradients(x, lens, y).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * (1 - 0.9 * step / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def label(self, pages: list, batch: int = 64) -> list:
        """Whether each block of each page is content; pages of like length share a padded batch."""
        import numpy as np

        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, x in enumerate(pages) if len(x)), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            take = max(1, min(batch, 20_000 // longest))   # bounds the memory of a batch of long pages
            part, order = order[-take:], order[:-take]
            x, lens = padded([pages[i] for i in part])
            z = self.scores(x, lens)
            for i, row, n in zip(part, z, lens):
                out[i] = row[:n] > 0
        return out


def padded(rows: list):
    import numpy as np

    lens = np.array([len(r) for r in rows])
    x = np.zeros((len(rows), lens.max(), rows[0].shape[1]), np.float32)
    for i, r in enumerate(rows):
        x[i, :len(r)] = r
    return x, lens


#: Element and attribute names that mark content or its surroundings. They label the
#: training sample; the network that learns from it decides.
CONTENT = frozenset("article main".split())
AROUND = frozenset("""nav header footer aside form menu button dialog class=ad class=ads class=advert class=advertisement class=sponsored
class=promo class=sidebar class=menu class=nav class=navigation class=navbar class=breadcrumb class=breadcrumbs class=header class=footer
class=notice class=cookie class=banner class=popup class=newsletter class=subscribe class=share class=social class=related class=comments
class=comment class=widget id=comments id=sidebar id=footer id=header id=nav id=menu id=cookie role=navigation role=banner
role=contentinfo role=complementary role=search""".split())
#: What training pages are varied with: plain paragraphs, and surroundings that may stand before, in or behind an article.
SURROUNDINGS = ["<p>{}</p>", "<p>{}<br><p>{}</p>", "<header><p>{}</p></header>", "<header class=\"header\"><div>{}</div></header>", "<aside><p>{}</p></aside>", "<aside class=\"sidebar\"><ul><li>{}</li></ul></aside>",
                "<div class=\"sidebar\"><p>{}</p></div>", "<div id=\"sidebar\"><h3>{}</h3></div>", "<div class=\"notice\">{}</div>", "<div class=\"cookie-notice\"><p>{}</p></div>",
                "<div class=\"cookie-banner\">{}</div>", "<form><label>{}</label><button>{}</button></form>", "<form class=\"subscribe\"><p>{}</p></form>",
                "<section class=\"comments\"><div class=\"comment\"><p>{}</p></div></section>", "<div id=\"comments\"><div class=\"comment\"><p>{}</p></div></div>",
                "<section id=\"comments\"><h2>{}</h2><article class=\"comment\"><p>{}</p></article></section>", "<div class=\"comments\"><p>{}</p></div>",
                "<div class=\"ads\">{}</div>", "<div class=\"ad\"><p>{}</p></div>", "<div class=\"advert\">{}</div>", "<div class=\"promo\">{}</div>", "<div class=\"banner\">{}</div>",
                "<div class=\"related\"><ul><li><a>{}</a></li></ul></div>", "<div class=\"share\">{}</div>", "<div class=\"menu\"><a>{}</a></div>",
                "<footer><p>{}</p></footer>", "<div class=\"footer\">{}</div>", "<nav class=\"breadcrumbs\"><a>{}</a></nav>", "<div role=\"navigation\"><a>{}</a></div>",
                "<div class=\"newsletter\"><p>{}</p></div>", "<div class=\"popup\">{}</div>", "<div class=\"social\">{}</div>", "<div class=\"widget\">{}</div>"]


def teach(path) -> float:
    """Label of a training block by its path: in an article, and in nothing that surrounds one."""
    return float(any(p in CONTENT for p in path) and not any(p in AROUND for p in path))


def varied(page: str, words: list[str], rng) -> str:
    """A training page with surroundings put in at random places about and between its blocks."""
    cuts = [m.start() for m in re.finditer(r"(?=<(?:article|nav|footer|p)\b)|(?=</article>)", page)] or [len(page)]
    for at in sorted(rng.choice(cuts, size=min(len(cuts), int(rng.integers(1, 6))), replace=False).tolist(), reverse=True):
        form = SURROUNDINGS[int(rng.integers(len(SURROUNDINGS)))]
        some = rng.integers(0, len(words), int(rng.integers(1, 40)))
        fill = [" ".join(words[int(k)] for k in (some if rng.random() < 0.8 else some[:1].repeat(len(some)))) for _ in range(form.count("{}"))]
        page = page[:at] + form.format(*fill) + page[at:]
    if rng.random() < 0.2:
        page = page.replace("<article", "<main").replace("</article", "</main")
    return page


#: What an article stands in on pages that do not name it: (start, end) in place of its tags.
CONTAINERS = [("<div>", "</div>"), ("<div class=\"content\">", "</div>"), ("<div id=\"main\">", "</div>"), ("<div class=\"post-body\">", "</div>"),
              ("<div class=\"entry\"><div>", "</div></div>"), ("<section>", "</section>"), ("<div id=\"page\"><div class=\"text\">", "</div></div>"),
              ("<table><tr><td>", "</td></tr></table>"), ("<div class=\"story\">", "</div>"), ("", "")]


def disguised(page: str, rng) -> str:
    """The page with its articles in containers that do not say so."""
    start, end = CONTAINERS[int(rng.integers(len(CONTAINERS)))]
    page = re.sub(r"(?i)<(article|main)\b[^>]*>", start, page)
    return re.sub(r"(?i)</(article|main)\s*>", end, page)


def train(pages: DataFrame, sample: int = SAMPLE_PAGES):
    """Network fitted on ``sample`` pages chosen by hash: as they are, with varied surroundings, and each of these
    once more with the container of the article replaced or left out, its blocks' labels kept."""
    import numpy as np

    known = pages.where("html is not null").select("page_id", F.col("html").cast("string").alias("html"), F.monotonically_increasing_id().alias("at"))
    rows = sorted(hash_sample(known, sample, "page_id", "at").collect(), key=lambda r: (r.page_id or 0, r.html))   # a bounded sample
    rng = np.random.default_rng(11)
    hashes = WordHashes()
    words = [html.escape(w) for r in rows for w in re.sub(r"<[^>]*>", " ", html.unescape(r.html)).split()] or ["word"]
    samples = []
    for r in rows:
        for page in (r.html, varied(r.html, words, rng), varied(r.html, words, rng)):
            found = blocks(page)[:SAMPLE_BLOCKS]
            labels = [teach(path) for _, path, _ in found]
            plain = blocks(disguised(page, rng))[:SAMPLE_BLOCKS]
            if found:
                samples.append((features(found, hashes), labels))
            if found and [t for t, _, _ in plain] == [t for t, _, _ in found]:
                samples.append((features(plain, hashes), labels))
    net = BiLstm(PATH + WORDS + NUMBERS)
    return net.fit(samples) if samples else net


def extract(pages: DataFrame, net: BiLstm) -> DataFrame:
    """page_id, url, text and n_chars of every page: its content blocks joined by one space.

    One map over the pages, no shuffle; every block of a page is labelled with
    the whole page in view, whatever its length. Null or empty html: empty text. Empty table: empty result.
    Null url and page_id pass through. Repeated rows give equal results; other
    columns are not read.
    """
    schema = T.StructType([T.StructField("page_id", pages.schema["page_id"].dataType), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType()), T.StructField("n_blocks", T.LongType())])

    def run(batches):
        import pyarrow as pa

        hashes = WordHashes()
        for batch in pieces(batches, 256, 2, 2 << 20):
            found = [blocks(p) for p in batch.column(2).to_pylist()]
            labels = net.label([features(b, hashes) for b in found])
            texts = [" ".join(text for (text, _, _), y in zip(b, good) if y) for b, good in zip(found, labels)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array([len(b) for b in found], pa.int64())], names=schema.names)

    return pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, schema)


def op10_block_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))

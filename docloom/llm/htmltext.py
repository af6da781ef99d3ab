"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into leaf blocks (runs of text between block-level tags) with their ancestors. Each block
has features of its ancestors' tags and class words and of its text; the chain's weights are trained by
gradient ascent on the likelihood of labelled pages, and a page is labelled by Viterbi.
"""

from __future__ import annotations

import functools
import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytetext import tidy
from .store import bounded_batches

#: Elements whose content is no text of the page; an unfinished one of HIDDEN hides the rest, of OPTIONAL only its tag.
HIDDEN, OPTIONAL = frozenset(("script", "style")), frozenset("noscript template svg textarea select iframe".split())
_NAME = re.compile(r"</?([a-zA-Z][^\s>/]*+)")
_STOP = re.compile(r">|=\s*+([\"'])")
_CLOSE = {name: re.compile(rf"</{name}\s*+>", re.I) for name in HIDDEN | OPTIONAL}
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CLASS_WORD = re.compile(r"[a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_ENDS = frozenset("table ul ol dl div article section main body".split())
#: Start tags that end an open element of the same kind.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
NOT_IN_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())


def tokens(page: str):
    """(text, "", "", False) and ("", tag name, attributes, whether it closes), in time linear in the page, however malformed.

    Quotes count after an equals sign, where they are closed before the page's last ">"; a "<" that no ">" follows is text.
    """
    n, last, at = len(page), page.rfind(">"), 0
    quote = {'"': -1, "'": -1}
    missing: set[str] = set()
    while at < n:
        start = page.find("<", at)
        if start < 0 or start > last:
            end = page.find("<!--", start) if start >= 0 else -1
            yield page[at : end if end >= 0 else n], "", "", False
            return
        if start > at:
            yield page[at:start], "", "", False
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else n
            continue
        named = _NAME.match(page, start)
        if not named:
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                at = page.find(">", start) + 1
            else:
                yield "<", "", "", False
                at = start + 1
            continue
        at = named.end()
        while (stop := _STOP.search(page, at))[0] != ">":
            at, q = stop.end(), stop[1]
            if quote[q] < at:
                quote[q] = k if (k := page.find(q, at)) >= 0 else n
            if quote[q] < last:
                at = quote[q] + 1
        name, closes, attributes = named[1].lower(), page[start + 1] == "/", page[named.end() : stop.start()]
        at = stop.end()
        if name in _CLOSE and not closes:
            if name in missing:
                continue
            if end := _CLOSE[name].search(page, at):
                at = end.end()
            elif name in HIDDEN:
                return
            else:
                missing.add(name)
            continue
        yield "", name, attributes, closes


class _Open:
    """The open elements: where each kind stands, how often each feature is above, all kept up by each push and pop."""

    def __init__(self):
        self.stack: list[tuple[str, list[str]]] = []
        self.where: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.above: dict[str, int] = {}

    def last(self, name: str) -> int:
        found = self.where.get(name)
        return found[-1] if found else -1

    def push(self, name: str, features: list[str]) -> None:
        self.where.setdefault(name, []).append(len(self.stack))
        if name not in INLINE:
            self.blocks.append(len(self.stack))
            for f in features:
                self.above[f] = self.above.get(f, 0) + 1
        self.stack.append((name, features))

    def pop_to(self, k: int) -> None:
        while len(self.stack) > k:
            name, features = self.stack.pop()
            self.where[name].pop()
            if name not in INLINE:
                self.blocks.pop()
                for f in features:
                    if self.above[f] == 1:
                        del self.above[f]
                    else:
                        self.above[f] -= 1


def leaf_blocks(page: str, known=None) -> list[tuple[str, tuple[str, ...], int]]:
    """(text, ancestor features, characters inside links) of each leaf block in page order, empty ones left out.

    known: the features to keep (default: all). Time is linear in the page for a fixed number of them.
    """
    blocks, text, linked, tree = [], [], 0, _Open()

    def end():
        nonlocal linked
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                near = tree.stack[tree.blocks[-1]][0] if tree.blocks else ""
                blocks.append((words, (*tree.above, "near:" + near), linked))
            text.clear()
        linked = 0

    for raw, name, attributes, closes in tokens(page):
        if raw:
            text.append(raw)
            if tree.where.get("a"):
                linked += len(raw)
            continue
        if name not in INLINE:
            end()
        elif name == "br":
            text.append(" ")
        if closes:
            k = tree.last(name)
            if k >= 0 and (name not in INLINE or not tree.blocks or k > tree.blocks[-1]):
                tree.pop_to(k)
            continue
        if name in VOID or attributes.endswith("/") and name in INLINE:
            continue
        ends = CLOSES.get(name) or ({"p"} if name in NOT_IN_P else ())
        k = max(map(tree.last, ends), default=-1)
        if k >= 0 and k > max(map(tree.last, BLOCK_ENDS)):
            tree.pop_to(k)
        features = []
        if name not in INLINE:
            features = ["in:" + name]
            if attributes:
                for a in _ATTRIBUTE.finditer(attributes):
                    features += ["is:" + w for w in _CLASS_WORD.findall((a[1] or a[2] or a[3] or "").lower())]
            features = [f for f in dict.fromkeys(features) if known is None or f in known]
        tree.push(name, features)
    end()
    return blocks


#: Words that tell in short blocks what a part of a page is; and those that start the readers' part.
CUES = frozenset("comment comments reply replies response responses discussion cookie cookies consent subscribe newsletter copyright rights reserved advertisement sponsored share related login sign search menu home contact privacy terms follow".split())
READERS = frozenset("comment comments reply replies response responses discussion".split())
_CUE = re.compile(r"[a-z]+")


def features(blocks: list[tuple[str, tuple[str, ...], int]]) -> list[list[str]]:
    """Ancestor-tag and text features of each block, and of the texts of its neighbours."""
    out, shapes, readers = [], [], False
    for text, above, linked in blocks:
        n = text.count(" ") + 1
        shape = [f"words:{min(6, n.bit_length())}", "links" if linked * 2 > len(text) else "no-links", "stop" if text[-1] in ".!?:;…" else "no-stop"]
        shapes.append(shape)
        cues = sorted(CUES.intersection(_CUE.findall(text.lower()))) if n <= 8 else []
        # A short text without a stop that names readers' words, outside links, starts their part of the page.
        readers = readers or n <= 4 and shape[1] == "no-links" and shape[2] == "no-stop" and not READERS.isdisjoint(cues)
        out.append([
            "bias", *above, *shape, "sign" if text[0] in "©&|»«›‹" else "no-sign", "commas" if "," in text else "no-commas",
            *("cue:" + c for c in cues), *(("readers",) if readers else ()),
        ])
    for k, row in enumerate(out):
        row += ["before:" + f for f in (shapes[k - 1] if k else ("none",))] + ["after:" + f for f in (shapes[k + 1] if k + 1 < len(out) else ("none",))]
    return out


class Chain:
    """Weights of a two-label chain: 0 other, 1 main text."""

    def __init__(self, names: list[str], weights: np.ndarray, step: np.ndarray):
        self.weights = {n: (float(w[0]), float(w[1])) for n, w in zip(names, weights)}
        self.step = [[float(x) for x in row] for row in step]

    def score(self, rows: list[list[str]], labels: list[int]) -> float:
        """What Viterbi makes largest."""
        each = sum(self.weights.get(f, (0.0, 0.0))[y] for row, y in zip(rows, labels) for f in row)
        return each + sum(self.step[a][b] for a, b in zip(labels, labels[1:]))

    def labels(self, rows: list[list[str]]) -> list[int]:
        """The likeliest labels (Viterbi); ties go to 0."""
        back, a, b = [], 0.0, 0.0
        (t00, t01), (t10, t11) = self.step
        weights = self.weights
        for k, row in enumerate(rows):
            x = y = 0.0
            for f in row:
                w = weights.get(f)
                if w:
                    x += w[0]
                    y += w[1]
            if k:
                from_a, from_b = int(b + t10 > a + t00), int(b + t11 > a + t01)
                a, b = (b + t10 if from_a else a + t00) + x, (b + t11 if from_b else a + t01) + y
                back.append((from_a, from_b))
            else:
                a, b = x, y
        state = int(b > a)
        out = [state] if rows else []
        for choice in reversed(back):
            state = choice[state]
            out.append(state)
        return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 150, rate: float = 1.0, decay: float = 1e-3) -> Chain:
    """Fit by gradient ascent (adaptive steps) on the penalised conditional log-likelihood, all pages side by side."""
    names, gradient = likelihood(pages, decay)
    w, step = np.zeros((len(names), 2)), np.zeros((2, 2))
    speed_w, speed_s = np.full_like(w, 1e-6), np.full_like(step, 1e-6)
    for _ in range(rounds):
        _, grad, grad_step = gradient(w, step)
        speed_w += grad**2
        speed_s += grad_step**2
        w, step = w + rate * grad / np.sqrt(speed_w), step + rate * grad_step / np.sqrt(speed_s)
    return Chain(names, w, step)


def likelihood(pages: list[tuple[list[list[str]], list[int]]], decay: float):
    """The features' names, and a function of the weights: mean penalised log-likelihood and its gradients (forward-backward)."""
    names = sorted({f for rows, _ in pages for row in rows for f in row})
    at = {n: i for i, n in enumerate(names)}
    longest = max(len(r) for r, _ in pages)
    x = np.zeros((len(pages), longest, len(names)), np.float32)
    y, on = np.zeros((len(pages), longest), int), np.zeros((len(pages), longest), bool)
    for p, (rows, labels) in enumerate(pages):
        for t, row in enumerate(rows):
            x[p, t, [at[f] for f in row]] = 1
        y[p, : len(rows)], on[p, : len(rows)] = labels, True
    flat_x = x.reshape(-1, len(names))
    gold = np.stack([(y == k) & on for k in (0, 1)], 2)
    pair_on = on[:, 1:] & on[:, :-1]
    gold_pairs = np.array([[((y[:, :-1] == i) & (y[:, 1:] == j) & pair_on).sum() for j in (0, 1)] for i in (0, 1)])

    def gradient(w: np.ndarray, step: np.ndarray):
        e = (flat_x @ w.astype(np.float32)).astype(np.float64).reshape(len(pages), longest, 2)
        f, b = np.zeros_like(e), np.zeros_like(e)
        f[:, 0] = e[:, 0]
        for t in range(1, longest):
            f[:, t] = np.where(on[:, t, None], np.logaddexp.reduce(f[:, t - 1, :, None] + step, axis=1) + e[:, t], f[:, t - 1])
        for t in range(longest - 2, -1, -1):
            b[:, t] = np.where(on[:, t + 1, None], np.logaddexp.reduce(step + (e[:, t + 1] + b[:, t + 1])[:, None, :], axis=2), 0)
        z = np.logaddexp.reduce(f[:, -1], axis=1)[:, None]
        p = np.exp(f + b - z[:, :, None]) * on[:, :, None]
        pair = np.exp(f[:, :-1, :, None] + step + (e + b)[:, 1:, None, :] - z[:, :, None, None]) * pair_on[:, :, None, None]
        value = ((e * gold).sum() + (gold_pairs * step).sum() - z.sum()) / len(pages) - decay / 2 * ((w**2).sum() + (step**2).sum())
        return value, flat_x.T @ (gold - p).reshape(-1, 2).astype(np.float32) / len(pages) - decay * w, (gold_pairs - pair.sum((0, 1))) / len(pages) - decay * step

    return names, gradient


def labelled_pages(n: int = 600, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Generated training pages with a label for each leaf block: sites of many layouts, bodies of invented words."""
    r = random.Random(seed)

    def words(k: int) -> str:
        w = ["".join(r.choice("etaoinshrdlcumé") for _ in range(r.randint(1, 9))) for _ in range(k)]
        return " ".join(w)

    def sentence(k: int | None = None) -> str:
        s = words(k or r.choice((1, 2, 4, 8, 15, 30, 60)))
        return s.capitalize() + r.choice((".", ".", ".", "", "!", ":", " %%%", " ***", ", " + words(3) + "."))

    def link(k: int) -> str:
        return f'<a href="/{words(1)}">{words(k)}</a>'

    def listed(k: int, label: int, of) -> list[tuple[str, int | None]]:
        out: list[tuple[str, int | None]] = [("<ul>", None)]
        for _ in range(k):
            out += [("<li>", None), (of(), label), (r.choice(("</li>", "</li>", "")), None)]
        return [*out, ("</ul>", None)]

    def wrapped(open_: str, inner: list[tuple[str, int | None]], close: str) -> list[tuple[str, int | None]]:
        return [(open_, None), *inner, (close, None)]

    def paragraphs(k: int, label: int) -> list[tuple[str, int | None]]:
        out: list[tuple[str, int | None]] = []
        for _ in range(k):
            body = sentence()
            if label and r.random() < 0.1:  # telling words in the text itself tell nothing
                body = r.choice(("All rights reserved.", f"{words(1)} {r.choice(sorted(CUES))} {words(1)}.".capitalize(), f"{r.choice(sorted(CUES))} {words(3)}".capitalize()))
            if r.random() < 0.2:
                body = r.choice(("<b>{}</b>", "{} <em>x</em>", "<b>{}<br>", "{} " + link(1) + " " + words(4))).format(body)
            out += [("<p>", None), (body, label), (r.choice(("</p>", "</p>", "</p>", "")), None)]
        return out

    def box(names: str, tags: str = "div section") -> tuple[str, str]:
        tag = r.choice(tags.split())
        name = r.choice(names.split())
        return f'<{tag} {r.choice(("class", "class", "id"))}="{name}">', f"</{tag}>"

    def aside() -> list[tuple[str, int | None]]:
        kind = r.randrange(9)
        if kind == 0:
            o, c = r.choice((("<nav>", "</nav>"), ("<nav>", "</nav>"), box("menu nav navbar main-menu breadcrumbs navigation", "div ul")))
            return wrapped(o, listed(r.randint(2, 7), 0, lambda: link(r.randint(1, 3))), c)
        if kind == 1:
            o, c = r.choice((("<header>", "</header>"), box("header site-header masthead top banner")))
            return wrapped(o, [(r.choice(("<h1>", "<p>", "<div>")), None), (sentence(r.randint(1, 5)), 0), ("</div>", None)], c)
        if kind == 2:
            o, c = r.choice((("<aside>", "</aside>"), box("sidebar side widget related recommended share social")))
            return wrapped(o, r.choice((paragraphs(r.randint(1, 3), 0), listed(r.randint(2, 5), 0, lambda: link(4)))), c)
        if kind == 3:
            o, c = box("ad ads advert advertisement sponsored promo banner")
            return wrapped(o, r.choice(([(sentence(), 0)], paragraphs(r.randint(1, 2), 0))), c)
        if kind == 4:
            o, c = box("cookie cookie-notice notice consent gdpr alert popup")
            return wrapped(o, r.choice(([(sentence(), 0)], paragraphs(1, 0))), c)
        if kind == 5:
            return wrapped("<form>", [("<p>", None), (sentence(r.randint(1, 6)), 0), ("</p><button>", None), (words(1), 0), ("</button>", None)], "</form>")
        if kind == 6:
            o, c = box("comments comment reader-comments responses discussion", "div section ol")
            return wrapped(o, [("<h3>", None), (words(1), 0), ("</h3>", None), *paragraphs(r.randint(1, 4), 0)], c)
        if kind == 7:
            o, c = box("newsletter subscribe signup login tags meta pagination")
            return wrapped(o, [(sentence(r.randint(1, 6)), 0)], c)
        return [("<div>", None), (r.choice((link(2), "© " + words(3), link(1) + " | " + link(1))), 0), ("</div>", None)]

    def readers() -> list[tuple[str, int | None]]:
        """What readers have written: elements with or without telling names, under a heading or not."""
        title = r.choice(("{} replies", "{} comments", "Comments", "Comments ({})", "Replies", "{} responses", "Discussion", "Leave a comment")).format(r.randint(1, 40))
        tag, close = r.choice((("article", True), ("div", True), ("li", False), ("section", True)))
        name = r.choice((' class="reply"', ' class="comment"', ' class="comment-body"', ' id="reply-7"', ' class="response"', ' class="post"', "", ""))
        h = r.choice(("h2", "h3", "h4", "p", "div"))
        out: list[tuple[str, int | None]] = [(f"<{h}>", None), (title, 0), (f"</{h}>", None)]
        for _ in range(r.randint(1, 4)):
            out.append((f"<{tag}{name}>", None))
            if r.random() < 0.5:
                out += [("<p>", None), (r.choice((link(1), words(2))) + r.choice(("", " says:", " wrote")), 0), ("</p>", None)]
            out += [*paragraphs(r.choice((1, 1, 2)), 0), (f"</{tag}>" if close else "", None)]
        return out

    def main_part(open_: str, close: str) -> list[tuple[str, int | None]]:
        """A title and paragraphs in elements that don't say what they are."""
        out: list[tuple[str, int | None]] = []
        if r.random() < 0.6:
            t = r.choice(("h1", "h2", "b", "div", "font size=5"))
            out += [(f"<{t}>" if t != "b" else "<div><b>", None), (sentence(r.randint(2, 8)), 1), (f"</{t.split()[0]}>" if t != "b" else "</b></div>", None)]
        for _ in range(r.randint(2, 8)):
            out += [(open_, None), (sentence(r.choice((4, 8, 15, 30, 60, 60))), 1), (close, None)]
        return out

    def links(k: int, between: str) -> tuple[str, int]:
        return between.join(link(r.randint(1, 2)) for _ in range(k)), 0

    def plain_page() -> list[tuple[str, int | None]]:
        """Elements without names: divisions, or a table."""
        menu = [("<div>", None), links(r.randint(2, 6), r.choice((" | ", " ", " &middot; "))), ("</div>", None)]
        if r.random() < 0.5:
            menu = [y for _ in range(r.randint(2, 6)) for y in (("<div>", None), (link(r.randint(1, 2)), 0), ("</div>", None))]
        foot_ = [("<div>", None), (r.choice(("&copy; 2024 {}.", "Copyright {}.", "{} All rights reserved.", "Contact | Privacy | {}")).format(words(2)), 0), ("</div>", None)]
        body = main_part(*r.choice((("<div>", "</div>"), ("<p>", "</p>"), ("<p>", ""))))
        more = readers() if r.random() < 0.25 else []
        if r.random() < 0.5:
            out = [("<div>", None), *(menu if r.random() < 0.9 else []), (r.choice(("<div>", "<center>", "")), None), *body, ("</div>", None), *more, *(foot_ if r.random() < 0.8 else []), ("</div>", None)]
            return out
        side = [("<td>", None), links(r.randint(2, 7), r.choice(("<br>", " ", " | "))), ("</td>", None)]
        if r.random() < 0.5:
            side = [("<td>", None), *[y for _ in range(r.randint(2, 6)) for y in (("<p>", None), (link(r.randint(1, 3)), 0), ("</p>", None))], ("</td>", None)]
        top = [("<tr><td colspan=2>", None), (r.choice((words(2), link(2))), 0), ("</td></tr>", None)] if r.random() < 0.5 else []
        cells = [("<td>", None), *body, ("</td>", None)]
        last = [("<tr><td>", None), (foot_[1][0], 0), ("</td></tr>", None)] if r.random() < 0.6 else []
        return [("<table>", None), *top, ("<tr>", None), *r.choice((side + cells, side + cells, cells + side)), ("</tr>", None), *last, ("</table>", None), *more]

    def foot() -> list[tuple[str, int | None]]:
        o, c = r.choice((("<footer>", "</footer>"), ("<footer>", "</footer>"), box("footer site-footer bottom copyright legal")))
        return wrapped(o, [(r.choice(("&copy; ", "")) + sentence(r.randint(1, 12)), 0)], c)

    pages = []
    for _ in range(n):
        body: list[tuple[str, int | None]] = []
        if r.random() < 0.5:
            body += [("<h1>", None), (sentence(r.randint(1, 8)), 1), ("</h1>", None)]
            if r.random() < 0.4:
                body = wrapped("<header>", body, "</header>")
        for _ in range(r.randint(1, 4)):
            body += paragraphs(r.choice((1, 1, 2, 4, 8)), 1)
            if r.random() < 0.25:
                body += [("<h2>", None), (sentence(r.randint(1, 5)), 1), ("</h2>", None)]
            if r.random() < 0.15:
                body += listed(r.randint(1, 5), 1, sentence)
            if r.random() < 0.1:
                body += wrapped(*[("<blockquote>", paragraphs(1, 1), "</blockquote>"), ("<pre>", [(sentence(), 1)], "</pre>"), ("<table><tr><td>", [(sentence(3), 1), ("<td>", None), (words(2), 1)], "</table>")][r.randrange(3)])
            if r.random() < 0.2:
                body += aside()
        o, c = r.choice((("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), box("content article post entry main story body text", "div div section"), ("<main><article>", "</article></main>")))
        page: list[tuple[str, int | None]] = [("<html><head><title>", None), (sentence(4), 0), ("</title></head><body>", None)]
        plain = r.random() < 0.3
        if plain:
            page += plain_page()
        else:
            for _ in range(r.randint(0, 3)):
                page += aside()
            page += wrapped(o, body, c)
            if r.random() < 0.2:
                page += readers()
            for _ in range(r.randint(0, 2)):
                page += aside()
        if not plain and r.random() < 0.8:
            page += foot()
        page.append((r.choice(("</body></html>", "")), None))
        source, labels = "".join(x for x, _ in page), [y for x, y in page if y is not None]
        pages.append((source, labels))
    return pages


@functools.cache
def train_default(n: int = 600, seed: int = 7) -> Chain:
    """The production chain: fitted on ``labelled_pages`` once in a process. Pages whose blocks don't match their labels are an error."""
    data = []
    for source, labels in labelled_pages(n, seed):
        blocks = leaf_blocks(source)
        if len(blocks) != len(labels):
            raise ValueError("a training page has other blocks than labels")
        data.append((features(blocks), labels))
    return train(data)


def main_text(page: str, chain: Chain) -> str:
    blocks = leaf_blocks(page, chain.weights)
    return "\n\n".join(b[0] for b, y in zip(blocks, chain.labels(features(blocks))) if y)


def extract(pages: DataFrame, chain: Chain, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """keep (default: all columns but html), text, n_chars: the main text of each whole page (null: empty).

    Blocks are joined by an empty line; white space inside a block becomes one space. Malformed and very
    long pages are read whole, in linear time: an unfinished tag is text, an unfinished comment, script
    or style hides the rest. Rows stay one to one, repeated ones alike; text and n_chars replace input
    columns of these names; an empty table gives an empty one.
    """
    bounded_batches(pages.sparkSession)
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars", html_col)]
    types = dict(zip(pages.columns, (f.dataType.simpleString() for f in pages.schema)))
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["text string, n_chars bigint"])
    shared = pages.sparkSession.sparkContext.broadcast(chain)

    @tidy
    def run(batches):
        for batch in batches:
            texts = [main_text(v.as_py() or "", shared.value) for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*keep, "text", "n_chars"])

    return pages.select(*[pages[f"`{c}`"] for c in keep], pages[f"`{html_col}`"].alias("__html")).mapInArrow(run, schema)

"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page decides which are its main text."""

import random
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.llm import crf, dom
from assaysieve.llm.text import per_text

LABELLED_PAGES = 700  # composed pages that the field is trained on
TABLE_PAGES = 200  # pages of the table whose own tags label them; those of smallest hash
SEED = 20

# How sites mark their main text and what is not part of it. Training pages are composed of these.
MAIN = ["article", "main", 'div class="content"', 'div class="post-body"', 'div id="main-content"', 'div class="entry-content"', 'section class="story"',
        'div class="article-body"', 'div class="post"', 'div class="text"', 'div itemprop="articleBody" class="body-copy"', 'div role="main"']
MENU = ["nav", 'div class="menu"', 'div class="navbar"', 'div class="breadcrumbs"', 'div class="pagination"', 'div class="toc"', 'div id="navigation"', 'ul class="tags"']
OTHER = ["header", "footer", "aside", 'div class="header"', 'div class="site-header"', 'div id="footer"', 'div class="sidebar"', 'div class="widget"', 'div class="ad"', 'div class="ads"',
         'div class="advert"', 'div class="advertisement"', 'div class="banner"', 'div class="sponsored"', 'div class="promo"', 'div class="cookie-notice"', 'div class="notice"',
         'div class="consent"', 'div class="alert"', 'div class="popup modal"', 'div class="newsletter subscribe"', 'div class="share social"', 'div class="related"', 'div class="recommended"',
         'div class="copyright"', 'div class="legal disclaimer"', 'div class="login"', 'div class="search"', 'div class="author-bio"']
TALK = ['div class="comments"', 'section id="comments"', 'ol class="commentlist"', 'div class="comment"', 'div class="replies"', 'div id="disqus" class="discussion"']
FORM = ["form", 'form class="newsletter"', "fieldset"]
BOILERPLATE = frozenset(f"in:{t}" for t in ("nav", "aside", "footer", "form", "fieldset", "button", "select", "option", "dialog", "menu", "search")) | frozenset(
    f"c:{w}" for w in """ad ads advert advertisement alert banner breadcrumb breadcrumbs comment commentlist comments consent cookie copyright disclaimer discussion disqus footer
    legal login menu modal nav navbar navigation newsletter notice pagination popup promo recommended related replies reply search share sidebar social sponsored subscribe tags toc widget""".split())


TALK_WORDS = frozenset("c:comment c:comments c:commentlist c:replies c:reply c:discussion c:disqus c:talk".split())
WIDE = 0.6  # share of the page's text from which an element is a frame around everything
RARE_PAGES = 3  # training pages that a word of an element's names must be on


def _shape(block: dom.Block) -> str:
    """Length and links of a block in one word, for its neighbours."""
    words = block.text.count(" ") + 1
    return f"{min(words.bit_length() // 2, 3)}{int(2 * block.linked > len(block.text))}"


def block_features(found: list[dom.Block], index: int) -> list[str]:
    """What the block's text, place and neighbours say."""
    block, total = found[index], len(found)
    text, n = block.text, len(block.text)
    words = text.count(" ") + 1
    linked = min(block.linked / n, 1.0)
    said = ["bias", f"words:{min(words.bit_length(), 8)}", f"linked:{round(linked * 4)}", f"shape:{_shape(block)}"]
    if text[-1] in ".!?…:\"”»":
        said.append("ends")
        if words >= 8 and linked < 0.5:
            said.append("sentence")
    if "©" in text or "(c)" in text[:20].lower():
        said.append("copyright")
    if "," in text:
        said.append("comma")
    said.append("first" if index == 0 else f"before:{_shape(found[index - 1])}")
    said.append("last" if index == total - 1 else f"after:{_shape(found[index + 1])}")
    return said


class Paths:
    """What the elements around a page's blocks say. A frame around most of the page's text is no sign by its names or by being a form, unless they tell of comments."""

    def __init__(self, page: int) -> None:
        self.page = page
        self.known: dict[int, frozenset[str]] = {}

    def of(self, element: dom.Element | None) -> frozenset[str]:
        chain, e = [], element
        while e is not None and id(e) not in self.known and e.text < WIDE * self.page:
            chain.append(e)
            e = e.around
        if e is None:
            said: frozenset[str] = frozenset()
        elif id(e) in self.known:
            said = self.known[id(e)]
        else:
            said = frozenset(w for tag, w in e.said if w in TALK_WORDS or (w.startswith("in:") and tag not in ("form", "fieldset", "div")))
            self.known[id(e)] = said
        for e in reversed(chain):
            own = {f"in:{e.tag}", *e.words}
            said = said if own <= said else said | own
            self.known[id(e)] = said
        return said


def features(found: list[dom.Block]) -> list[list[str]]:
    paths = Paths(dom.measure(found))
    return [[*sorted(paths.of(b.element)), *block_features(found, i)] for i, b in enumerate(found)]


def own_labels(found: list[dom.Block]) -> list[int] | None:
    """Labels of a page that marks its main text with `article` or `main`: blocks inside, but not in a part known to be none. Else None."""
    said = [set() if b.element is None else {w for _, w in b.element.said} for b in found]
    inside = [bool(s & {"in:article", "in:main"}) and not BOILERPLATE & s for s in said]
    return [int(x) for x in inside] if any(inside) else None


def composed(seed: int, pages: int) -> list[tuple[str, list[int]]]:
    """Labelled pages: main parts, with parts that do not belong before, after and inside them, over random text."""
    rng = random.Random(seed)
    syllables = "ba co da el fi gu ha in jo ka lo me no or pu ra se ti un vo".split()

    def phrase(least: int, most: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(least, most)))

    def sentence(least: int = 4, most: int = 30) -> str:
        return phrase(least, most).capitalize() + rng.choice([".", ".", ".", "!", "", ","])

    def part(kinds: list[str]) -> tuple[str, list[int]]:
        opened = rng.choice(kinds)
        tag = opened.split()[0]
        style = rng.random()
        if tag == "ul" or kinds is MENU:
            n = rng.randint(1, 7)
            items = "".join(f'<li><a href="#">{phrase(1, 3)}</a></li>' for _ in range(n))
            inner = items if tag == "ul" else f"<ul>{items}</ul>"
        elif kinds is FORM:
            n = rng.randint(1, 3)
            inner = "".join(f"<p>{phrase(1, 6)} <input></p>" for _ in range(n))
        elif style < 0.4:
            n, inner = 1, sentence(2, 14)
        elif style < 0.6:
            n, inner = 1, f"&copy; {phrase(1, 3)} &middot; {sentence(3, 12)}"
        else:
            n = rng.randint(1, 4)
            inner = "".join(f"<p>{sentence()}</p>" for _ in range(n))
        return f"<{opened}>{inner}</{tag}>", [0] * n

    def prose() -> tuple[str, list[int]]:
        style = rng.random()
        if style < 0.7:
            return f"<p>{sentence(1, 60)}</p>", [1]
        if style < 0.8:
            return f"<h{(k := rng.randint(2, 4))}>{phrase(1, 8)}</h{k}>", [1]
        if style < 0.88:
            n = rng.randint(1, 4)
            return "<ul>" + "".join(f"<li>{sentence(1, 12)}</li>" for _ in range(n)) + "</ul>", [1] * n
        if style < 0.94:
            return f"<blockquote>{sentence(3, 30)}</blockquote>", [1]
        return f'<p>{sentence(2, 10)} <a href="#">{phrase(1, 6)}</a> {sentence(1, 10)}</p>', [1]

    def unmarked() -> tuple[str, list[int]]:
        """A part that only its text tells from the article: links, or a line of rights."""
        style = rng.random()
        tag = rng.choice(["div", "div", "p", "td", "span"])
        if style < 0.6:
            n = rng.randint(2, 8)
            links = [f'<a href="#">{phrase(1, 3)}</a>' for _ in range(n)]
            if rng.random() < 0.5:
                return "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>", [0] * n
            return f"<{tag}>{' | '.join(links)}</{tag}><hr>", [0]
        return f"<{tag}>&copy; {phrase(1, 4)}</{tag}><hr>", [0]

    def name() -> str:
        """A wrapper that means nothing: no names, or such as are on no other page."""
        return rng.choice(["div", "div", "section", "table><tr><td", f'div class="{phrase(1, 2)}"', f'div id="{phrase(1, 1)}"'])

    def closed(opened: str) -> str:
        return "".join(f"</{part.split()[0].strip('<>')}>" for part in reversed(opened.split("><")))

    out = []
    for _ in range(pages):
        body, labels = [], []

        def put(piece: tuple[str, list[int]], body=body, labels=labels) -> None:
            body.append(piece[0])
            labels.extend(piece[1])

        plain = rng.random() < 0.5  # whether no element marks the article
        frames = [name() for _ in range(rng.choice([0, 0, 1, 2, 4]))]
        if rng.random() < 0.15:
            frames.insert(0, 'form id="page"')
        body += [f"<{f}>" for f in frames]
        for kinds in rng.sample([MENU, OTHER, OTHER, FORM], rng.randint(0, 4)):
            put(unmarked() if plain and rng.random() < 0.5 else part(kinds))
        opened = rng.choice(["", name(), name()]) if plain else rng.choice(MAIN[:2] * 3 + MAIN)
        body.append(f"<{opened}>" if opened else "")
        if rng.random() < 0.3:
            body.append("<header>" if not plain else "<div>")
            put((f"<h1>{phrase(2, 10)}</h1>", [1]))
            body.append("</header>" if not plain else "</div>")
        elif rng.random() < 0.8:
            put((f"<h1>{phrase(2, 10)}</h1>", [1]))
        inner = name() if rng.random() < 0.3 else ""
        body.append(f"<{inner}>" if inner else "")
        for _ in range(rng.randint(1, 12)):
            own = name() if rng.random() < 0.15 else ""
            body.append(f"<{own}>" if own else "")
            put(prose())
            body.append(closed(own) if own else "")
            if rng.random() < 0.12:
                put(part(rng.choice([OTHER, OTHER, FORM, MENU, TALK])))
        body.append(closed(inner) if inner else "")
        if rng.random() < 0.3:
            put(part(TALK))
        body.append(closed(opened) if opened else "")
        for kinds in rng.sample([OTHER, OTHER, TALK, FORM, MENU], rng.randint(0, 4)):
            put(unmarked() if plain and rng.random() < 0.5 else part(kinds))
        body += [closed(f) for f in reversed(frames)]
        head = f"<head><title>{phrase(2, 6)}</title>" + ("</head><body>" if rng.random() < 0.9 else "")
        out.append((f"<!DOCTYPE html><html>{head}{''.join(body)}", labels))
    return out


def fit(pages: DataFrame | None = None, markup: str = "html", labelled: int = LABELLED_PAGES, table_pages: int = TABLE_PAGES) -> crf.Chain:
    """Train on composed labelled pages and on at most `table_pages` pages whose own article or main element labels them."""
    chosen = [(dom.blocks(p), labels) for p, labels in composed(SEED, labelled)]
    if pages is not None:
        hashed = pages.where(F.col(markup).isNotNull()).select(F.xxhash64(markup).alias("h"))
        # Hashes alone are sorted, then only the chosen pages are read whole.
        last = hashed.orderBy("h").limit(table_pages).agg(F.max("h")).first()[0]
        if last is not None:
            for row in pages.where(F.xxhash64(markup) <= F.lit(last)).select(markup).distinct().limit(table_pages).collect():
                found = dom.blocks(row[0])
                labels = own_labels(found)
                if labels:
                    chosen.append((found, labels))
    told = [(features(b), labels) for b, labels in chosen if len(b) == len(labels) and len(b) <= 400]
    pages_with = Counter(f for places, _ in told for f in {f for place in places for f in place})
    known = [([[f for f in place if pages_with[f] >= RARE_PAGES] for place in places], labels) for places, labels in told]
    return crf.train(sorted(known, key=lambda p: (len(p[0]), p)))


def extractor(model: crf.Chain):
    """The function from pages to their main texts; scores of element paths are remembered."""
    weight, scores_of = model.weights.get, {}

    def rows(pages: list[str | None]) -> list[tuple]:
        out = []
        for page in pages:
            found = dom.blocks(page)
            paths, scores = Paths(dom.measure(found)), []
            for i, b in enumerate(found):
                path = paths.of(b.element)
                if path not in scores_of:
                    if len(scores_of) > 20_000:
                        scores_of.clear()
                    scores_of[path] = sum(weight(f, 0.0) for f in sorted(path))
                scores.append(scores_of[path] + sum(weight(f, 0.0) for f in block_features(found, i)))
            labels = model.decode(scores)
            kept = [b.text for b, label in zip(found, labels, strict=True) if label]
            out.append(("\n".join(kept), len(found), len(kept)))
        return out

    return rows


def extract(pages: DataFrame, model: crf.Chain, markup: str = "html", out: str = "main") -> DataFrame:
    """The pages with a struct column `out`: text (main blocks joined by line feeds), n_blocks and n_kept.

    Null and empty pages, and pages without main blocks, have the empty text. A column called `out` is replaced, all others stay.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    return pages.withColumn(out, per_text(lambda: extractor(shared.value), "text string, n_blocks bigint, n_kept bigint")(F.col(markup)))


def digest(pages: DataFrame) -> DataFrame:
    found = extract(pages.select("page_id", "url", "html"), fit(pages))
    return found.select("page_id", "url", F.col("main.text").alias("text"), F.length("main.text").cast("bigint").alias("n_chars"))

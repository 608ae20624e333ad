"""Composed pages with known main text, from which the block labeller learns.

Sites differ in how they mark up the same parts, so a page is put together at random: a container for the article, by tag or by class
name, and around it, and sometimes inside it, menus, headers, footers, sidebars, notices, adverts, forms and comments. Words are made of
random syllables; parts that are not main text also use the stock phrases of such parts, and now and then so does an article.
"""

from __future__ import annotations

import html
import math
import random

# Phrases of the parts around an article, by part, in the four languages of the tables.
PHRASES = {
    "menu": "home|about us|contact|news|products|services|startseite|über uns|kontakt|produkte|accueil|à propos|nouvelles|inicio|noticias|contacto|login|register|search|sitemap|archive|blog",
    "header": "welcome to our site|subscribe|sign in|search this site|my account|skip to content|anmelden|suche|connexion|recherche|buscar|iniciar sesión",
    "footer": "© all rights reserved|privacy policy|terms of use|imprint|copyright|powered by|impressum|datenschutz|mentions légales|aviso legal|política de privacidad|cookies|·|contact us",
    "side": "related articles|popular posts|recent comments|tags|categories|you may also like|most read|follow us|ähnliche artikel|articles liés|artículos relacionados|share this|tweet|archive",
    "notice": "this site uses cookies|accept|we value your privacy|javascript is disabled|diese seite verwendet cookies|ce site utilise des cookies|este sitio utiliza cookies|please update your browser|breaking|close",
    "ad": "advertisement|sponsored|buy now|special offer|anzeige|publicité|publicidad|click here|% off|free shipping|promo",
    "form": "your name|email address|submit|subscribe to our newsletter|send|password|nachricht|envoyer|enviar|message|i agree|search",
    "comments": "says|reply|posted by|at|comments|leave a comment|kommentare|commentaires|comentarios|antworten|répondre|responder|like|report|ago|great post",
}
# How sites name the containers of each part: tag, then class or id words.
CONTAINERS = {
    "menu": "nav|nav.main-nav|div.menu|div.navbar|ul.nav|ul.menu|div#navigation|div.breadcrumbs|div.topnav|nav.pagination|div.pager",
    "header": "header|div.header|div#header|div.masthead|header.site-header|div.top-bar|div.banner|div.branding",
    "footer": "footer|div.footer|div#footer|footer.site-footer|div.copyright|div.bottom|div.legal",
    "side": "aside|div.sidebar|div#sidebar|aside.related|div.widget|div.related-posts|section.recommended|div.share|div.social|div.tags|div.author-box",
    "notice": "div.cookie-notice|div.notice|div#cookie-banner|div.alert|div.popup|div.modal|div.consent|section.notification|div.gdpr",
    "ad": "div.ad|div.ads|div.advert|div#ad|div.sponsored|aside.advertisement|div.promo|div.banner-ad|section.sponsor|div.adsbygoogle",
    "form": "form|form.search|div.newsletter|form#subscribe|div.signup|form.contact|div.login-form",
    "comments": "section.comments|div#comments|div.comment-list|ol.comments|div.comment|section#respond|div.disqus|ul.comment-thread",
}
# How sites name the article's own container.
ARTICLES = (
    "article|article|article|main|div.content|div.post|div#content|div.entry-content|section.article-body|div.story|article.post|div.text|"
    "div.article|main.page|div.body-text|section|div|div#main|td.content|div.post-content|article.entry"
)
OUTER = ("", "div.wrapper", "div#page", "div.container", "main", "section", "div", "div.row", "div.page-wrap", "table")

_SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ch un die ge sch ein ich el la que os ció ent aux eau oi é ê ü ß ñ".split()


class Composer:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.pick = self.rng.choice

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def some(self, most: float) -> int:
        """From 1 to ``most``, smaller numbers more often."""
        return int(math.exp(self.rng.uniform(0, math.log(most))))

    def words(self, most: int) -> str:
        text = " ".join("".join(self.rng.choices(_SYLLABLES, k=self.rng.randint(1, 4))) for _ in range(self.some(most + 1)))
        return text.capitalize() + self.pick([".", ".", ".", "", "!", "?", " &", "$$$", "###"])

    def phrase(self, part: str) -> str:
        return self.pick(PHRASES[part].split("|"))

    def container(self, name: str, inner: str) -> str:
        if not name:
            return inner
        tag, mark = name, ""
        for sign, attribute in ((".", "class"), ("#", "id")):
            if sign in name:
                tag, value = name.split(sign)
                mark = f' {attribute}="{value}"'
        if tag == "table":
            return f"<table{mark}><tr><td>{inner}</td></tr></table>"
        if tag == "td":
            return f"<table><tr><td{mark}>{inner}</td></tr></table>"
        return f"<{tag}{mark}>{inner}</{tag}>"

    def line(self, part: str) -> str:
        """A line of a part that is no main text: a phrase of the part, other words, or both."""
        kind = self.rng.random()
        if kind < 0.3:
            return self.phrase(part)
        if kind < 0.55:
            return f"{self.phrase(part)} {self.words(12)}"
        return self.words(40 if part in ("comments", "ad", "side", "notice") else 8)

    def around(self, part: str) -> str:
        name = self.pick(CONTAINERS[part].split("|"))
        n = self.rng.randint(1, 8)
        lines = [html.escape(self.line(part)) for _ in range(n)]
        if part == "menu" or name.startswith(("ul", "ol")) or self.chance(0.15):
            items = "".join(f'<li><a href="/x">{t}</a></li>' if part == "menu" or self.chance(0.4) else f"<li>{t}</li>" for t in lines)
            inner = items if name.startswith(("ul", "ol")) else f"<ul>{items}</ul>"
        elif part == "form":
            inner = "".join(self.pick(["<label>{}</label><input>", "<button>{}</button>", "<p>{}</p>", "<legend>{}</legend>"]).format(t) for t in lines)
        elif part in ("ad", "footer", "notice", "header") and self.chance(0.6):
            inner = lines[0] if self.chance(0.5) else f"{lines[0]} &middot; {html.escape(self.words(10))}"
        else:
            inner = "".join(self.pick(["<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<h3>{}</h3>", "<span>{}</span>", '<p><a href="/y">{}</a></p>']).format(t) for t in lines)
        return self.container(name, inner)

    def article(self) -> tuple[str, list[str]]:
        """HTML of the article's inside and its blocks."""
        kept, out = [], []

        def put(template: str, text: str) -> None:
            if self.chance(0.04):
                text = f"{text} {self.phrase(self.pick(list(PHRASES)))}"
            kept.append(" ".join(text.split()))
            body = html.escape(text, quote=False)
            if self.chance(0.12):
                cut = body.split(" ")
                cut[0] = self.pick(["<b>{}</b>", "<em>{}</em>", '<a href="/z">{}</a>', "<b>{}"]).format(cut[0])
                body = " ".join(cut)
            out.append(template.format(body))

        if self.chance(0.85):
            put(self.pick(["<h1>{}</h1>", "<h1>{}</h1>", "<h2>{}</h2>", '<h1 class="title">{}</h1>']), self.words(14))
        plain = self.pick(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>"])
        broken = self.chance(0.3)
        for _ in range(self.rng.randint(20, 160) if self.chance(0.12) else self.some(30)):
            kind = self.rng.random()
            if kind < 0.06:
                put("<h2>{}</h2>", self.words(8))
            elif kind < 0.1:
                put("<blockquote>{}</blockquote>", self.words(30))
            elif kind < 0.14:
                for _ in range(self.rng.randint(2, 4)):
                    put("<li>{}</li>", self.words(12))
            elif kind < 0.16:
                put("<figure><figcaption>{}</figcaption></figure>", self.words(12))
            elif broken and kind < 0.35:
                put("<p><b>{}<br>", self.words(90))
            else:
                put(plain, self.words(90))
            if self.chance(0.04):
                out.append(self.around(self.pick(["ad", "side", "form", "notice"])))
        if self.chance(0.12):
            out.append(self.around(self.pick(["comments", "side", "form", "ad"])))
        return "".join(out), kept

    def page(self) -> tuple[str, set[str]]:
        """A page and the texts of its main blocks."""
        inner, kept = self.article()
        body = self.container(self.pick(ARTICLES.split("|")), inner)
        before = [self.around(p) for p in ("header", "menu", "notice", "ad", "side", "form") if self.chance(0.4)]
        after = [self.around(p) for p in ("comments", "ad", "side", "form", "menu", "notice", "footer") if self.chance(0.4)]
        self.rng.shuffle(before)
        whole = self.container(self.pick(OUTER), "".join(before) + body + "".join(after))
        return f"<!DOCTYPE html><html><head><title>{kept[0][:60]}</title></head><body>{whole}</body></html>", set(kept)

from __future__ import annotations

import pytest

from basketry.llm import html


RUSSIAN = "<p>Вчера вечером на берегу реки собрались жители города, чтобы обсудить новый мост и дорогу к старой мельнице.</p>"
JAPANESE = "<p>昨日の夕方、町の住民が川岸に集まり、新しい橋と古い水車小屋へ続く道について長い時間をかけて話し合いました。</p>"
LINKS = "<div><a href=/a>Первая страница</a> <a href=/b>Вторая страница</a></div>"
ENGLISH = "<p>The first of all the words that are here, and there is more of them to be had for you and for us.</p>"


@pytest.mark.parametrize("paragraph", [RUSSIAN, JAPANESE])
def test_languages_without_stop_words_keep_their_paragraphs(paragraph):
    page = f"<body>{LINKS}{paragraph}{paragraph}<p>Да.</p>{LINKS}</body>"
    text = html.main_text(page)
    assert text.count(paragraph[3:-4]) == 2 and "страница" not in text
    assert paragraph[3:-4] in html.main_text(f"<body>{ENGLISH}{paragraph}{ENGLISH}</body>")


def test_stop_words_still_decide_where_the_language_is_listed():
    junk = "<div>Alpha Bravo Charlie Delta Echo Foxtrot Golf Hotel India Juliett Kilo Lima Mike November</div>"
    assert html.main_text(f"<body>{ENGLISH}{ENGLISH}{junk}</body>").count("Alpha") == 0


@pytest.mark.parametrize("mark", ["content has-sidebar", "no-sidebar", "layout--with-sidebar", "post no_comments"])
def test_a_page_layout_is_no_sidebar(mark):
    assert html.main_text(f"<body><div class='{mark}'>{ENGLISH}</div></body>") == ENGLISH[3:-4]
    assert html.main_text(f"<body>{ENGLISH}<div class='{mark.split()[0]}'><div class='left-sidebar'>Short</div></div></body>") == ENGLISH[3:-4]

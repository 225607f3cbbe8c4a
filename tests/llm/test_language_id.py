from __future__ import annotations

from collections import Counter

import numpy as np
from helpers import LONG, ODD, frame, read
from pyspark.sql import functions as F

from tripflow.llm import common
from tripflow.llm import language_id as li

EN = "the cat sat on the mat and the dog ran over the hill with a stick in its mouth "
DE = "der hund und die katze sind auf dem weg nach hause und warten auf das wetter "


def phrases(known: str, text: str) -> int:
    """Longest phrases of the known text, found by search in it."""
    at = count = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        at = max(at + 1, end - 1)
        count += 1
    return count


def test_automaton_is_the_greedy_parse():
    dice = np.random.default_rng(1)
    for _ in range(20):
        known, text = (dice.integers(0, 4, n).tolist() for n in (60, 90))
        table = li.parse_table(known, 5)
        model = li.Model(["x"], np.zeros(1, np.uint8), [table], 5)
        streams = [np.array(text[a:b], np.uint8) for a, b in ((0, 90), (5, 6), (10, 60))]
        expected = [phrases("".join(map(str, known)), "".join(map(str, s))) for s in streams]
        assert model.phrases(streams)[0].tolist() == expected


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01")
    held_out = common.crc_part(F.col("doc_id"), 3) == 1
    got = li.identify(docs, li.sample(docs.where(~held_out)), held_out).join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


LEARNT = {
    "zh": "今天天气很好，我们一起去公园散步。他在北京的一家公司工作，每天早上坐地铁上班。这本书是我最喜欢的，因为里面的故事很有意思。"
          "中国有很长的历史和丰富的文化，很多人都想学习中文。如果你有时间，请来我家吃饭，我妈妈会做很多好吃的菜。",
    "ja": "今日は天気がいいので、公園を散歩しました。彼は東京の会社で働いていて、毎朝電車で通勤しています。この本は私の一番好きな本です。"
          "日本には長い歴史と豊かな文化があり、多くの人が日本語を勉強したいと思っています。時間があれば、私の家に食事に来てください。",
    "ko": "오늘은 날씨가 좋아서 우리는 공원에서 산책을 했습니다. 그는 서울에 있는 회사에서 일하고 매일 아침 지하철로 출근합니다. 이 책은 제가 가장 좋아하는 책입니다. "
          "한국은 긴 역사와 풍부한 문화를 가지고 있으며 많은 사람들이 한국어를 배우고 싶어합니다. 시간이 있으면 우리 집에 식사하러 오세요.",
    "ru": "Сегодня хорошая погода, и мы вместе пошли гулять в парк. Он работает в большой компании в Москве и каждое утро ездит на метро. "
          "Эта книга мне очень нравится, потому что в ней есть интересные истории. Если у вас есть время, приходите к нам в гости, мы будем рады.",
    "uk": "Сьогодні гарна погода, і ми разом пішли гуляти до парку. Він працює у великій компанії в Києві та щоранку їздить на метро. "
          "Ця книга мені дуже подобається, тому що в ній є цікаві історії. Якщо у вас є час, приходьте до нас у гості, ми будемо раді.",
    "bg": "Днес времето е хубаво и ние отидохме заедно на разходка в парка. Той работи в голяма компания в София и всяка сутрин пътува с метрото. "
          "Тази книга много ми харесва, защото в нея има интересни истории. Ако имате време, елате ни на гости, ще се радваме да ви видим.",
    "el": "Σήμερα ο καιρός είναι καλός και πήγαμε μαζί μια βόλτα στο πάρκο. Αυτός δουλεύει σε μια μεγάλη εταιρεία στην Αθήνα και κάθε πρωί παίρνει το μετρό.",
    "ar": "الطقس جميل اليوم وذهبنا معا للتنزه في الحديقة. هو يعمل في شركة كبيرة في القاهرة ويذهب كل صباح بالمترو إلى العمل.",
    "fa": "امروز هوا خوب است و ما با هم برای قدم زدن به پارک رفتیم. او در یک شرکت بزرگ در تهران کار می‌کند و هر روز صبح با مترو می‌رود.",
    "en": EN, "de": DE,
}
HELD_OUT = [
    ("zh", "我们每天早上都去学习，他的家里有很多书。"), ("zh", "他今天在家，因为天气不好。"), ("zh", "很多人喜欢北京的文化和历史"),
    ("ja", "私は毎朝公園を散歩しています。"), ("ja", "彼の家には多くの本があります。"), ("ja", "東京は今日天気がよかったです"),
    ("ko", "저는 매일 아침 공원에서 책을 읽습니다."), ("ko", "많은 사람들이 서울에 오고 싶어합니다."), ("ko", "우리는 오늘 집에 있습니다"),
    ("ru", "Мы каждое утро ходим в парк, и нам это очень нравится."), ("ru", "Эта хорошая книга есть у него."),
    ("uk", "Ми щоранку ходимо до парку, і нам це дуже подобається."), ("uk", "Ця цікава книга є в нього."),
    ("bg", "Всяка сутрин отиваме в парка и това много ни харесва."), ("bg", "Той има тази хубава книга."),
    ("el", "Κάθε πρωί πηγαίνω στο πάρκο με το μετρό."), ("ar", "ذهبنا اليوم إلى العمل في شركة كبيرة."), ("fa", "او هر روز با مترو به پارک می‌رود."),
    ("en", "the dog sat on the hill"), ("de", "das wetter ist auf dem weg"),
]


def test_held_out_texts_of_many_scripts():
    model = li.build(sorted(LEARNT.items()))
    names, scores = model.predict([t for _, t in HELD_OUT])
    assert names == [x for x, _ in HELD_OUT] and min(scores) > 0


def test_letters_of_two_symbols_are_distinct():
    counts = Counter({k: 5000 - k for k in range(2, 3002)})
    own = li.alphabet(counts, 3100, 64)
    spelt = {tuple(own.spelt(np.array([k]))) for k in range(2, 3002)}
    assert len(spelt) == 3000 and all(1 < s < own.size for x in spelt for s in x)
    assert sum(len(x) == 1 for x in spelt) == 62 and own.spelt(np.array([0, 3050])) == [0, 1]


def test_sample_is_bounded_and_has_every_language(spark):
    rows = [(i, EN, "en", "a", 0) for i in range(300)] + [(1000, DE, "de", "b", 0), (1001, "x", None, "b", 0), (1002, None, "fr", "b", 0)]
    got = li.sample(frame(spark, rows), per_language=5, chars=10)
    assert sorted(x for x, _ in got) == ["de"] + ["en"] * 5 and max(len(t) for _, t in got) == 10


def test_odd_rows(spark):
    samples = [("en", EN), ("de", DE)]
    got = li.identify(frame(spark, ODD + [(8, "12 34 !?", None, None, 0), (9, "日本語", "ja", None, 0)], clash=True), samples).collect()
    by = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(ODD) + 2 and by[4] in ("en", "de") and LONG
    assert {by[i] for i in (1, 2, 3, 8)} == {"und"} and by[9] != "und"
    kept = li.keep_identified(frame(spark, ODD, clash=True), samples)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 5, 5, 6] and len(kept.columns) == 17


def test_without_labels_or_rows(spark):
    assert {r.lang_pred for r in li.identify(frame(spark, ODD), []).collect()} == {"und"}
    assert li.keep_identified(frame(spark, ODD), []).count() == 5
    assert li.identify(frame(spark, []), li.sample(frame(spark, []))).collect() == []

"""Word and character lists of the text gates."""

from __future__ import annotations

# These lists must be as they are for right results.
CANTONESE_CHARS = "係冇佢呢嗰嚟咁嘅囉喎啩咋啦啲喺唔咗嘢搵睇啱攞唞攰𠻹諗㗎喇乜哋俾俾瞓掟喐踎揸揼黐搣𠮶叻咪咩噏嘥嚿搲氹"
SIMPLIFIED_CHARS = (
    "这们说时会对为当东乐车书无写听见让应义证认识双农"
    "发动关变质务设机飞门产类总积带济战县观讲谁课谢语译诉读误"
    "岁圆块坏处复万党兴击划创协卖卫归录弥弯弹态忆忧怀"
    "恳恶惊惧惨惩惭惮惯愤愿懒戏户执扩扫扬扭扮扰护报担"
    "拟拢拣拥拦拨择挥挤损换搅携摆摇撑敌数斩显"
)
MANDARIN_CHARS = "是的他她們這那說沒誰吃喝看哪怎"
CANTONESE_WORDS = (
    "而家 唔係 點解 幾時 即係 邊度 乜嘢 噉樣 一齊 係咪 真係 已經 好似 先至 仲有 唔使 或者 點樣 緊要 鐘意 鍾意 返去 企喺 呢個 呢啲 嗰個 嗰啲"
    " 佢哋 我哋 你哋 話俾 話畀 收聲 話之 企定 睇吓 玩嘢 諗住 講嘢 喇喎 㗎啦 㗎喇 唔好 咪話 冇人"
).split()
MANDARIN_WORDS = (
    "現在 现在 為什麼 为什么 什麼 什么 時候 时候 這樣 这样 我們 我们 你們 你们 他們 他们 她們 她们 是不是 真的 怎麼 怎么 怎麼樣 怎么样 那樣 那样 這個 这个 這些 这些 那個 那个"
    " 那些 一起 哪裡 哪里 不要 去哪 告訴 告诉 那是 這是 这是 就是 特別是 特别是 什麼的 什么的 昨天 明天 吃過 吃过 看過 看过 去過 去过 走了 來了 来了 對不起 对不起 謝謝 谢谢 剛才 刚才"
).split()
NEUTRAL_WORDS = "的士 的確 目的 了解 除了 不得了 受不了 甚至乎 著名 著作 著急 著手 說法 說明 小說 話說 可是 是否 總是 要是 就是 國是 是非 若是 看法".split()

MUSIC_WORDS = "music,jingle,singing,song,choir,rapping,melody,tune,instrument,guitar,piano,drum,orchestr,violin,trumpet,harmonica,accordion,synthesizer,bass,cello,flute,saxophone,organ,banjo,mandolin,harp,trombone,brass,wind instrument,percussion,cymbal,gong,string,keyboard (musical),theme".split(",")
NOT_MUSIC = ("Speech synthesizer", "Bird vocalization, bird call, bird song")

#: CJK ideographs: the unified blocks, extensions A to H, and the compatibility block.
CJK_CLASS = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{2CEB0}-\x{2EBF0}\x{30000}-\x{3134F}\x{31350}-\x{323AF}\x{F900}-\x{FAFF}"
ENGLISH_WORD = "[a-zA-Z]+(?:'[a-zA-Z]+)?"

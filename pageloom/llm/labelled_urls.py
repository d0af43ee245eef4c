"""A small labelled URL table, written by hand on reserved names; the default of the URL filter."""

#: Addresses to block, then addresses to allow.
BLOCK = """
http://casino-royal.example/win  https://www.online-casino.example/play/slots  http://big-casino-bonus.example/en/12
https://poker-casino.example/jackpot  http://winbig-lottery.example/claim  https://www.lotto-win.example/en/4
http://pills-online.example/buy  https://www.cheap-meds.example/en/pills/7  http://best-pills-shop.example/order
https://cheap-viagra.example/en/331  http://diet-pills-now.example/offer  https://discount-pills.example/fr/18
http://free-bets-today.example/odds  https://www.sport-bets.example/en/free  http://bets-and-odds.example/de/5
https://free-spins.example/bonus  http://free-money-fast.example/claim  https://get-free-cash.example/now
http://link-farm.example/en/77  https://www.spam-links.example/page/3  http://spam-blast.example/list
https://content-farm.example/en/900  http://seo-farm-links.example/es/41  https://spamhub.example/en/2
http://ads-server.example/click  https://www.ads-tracking.example/en/pixel  http://track-clicks.example/en/ads/9
https://adtrack.example/banner  http://popup-ads.example/en/61  https://tracker-ads.example/de/15
http://xxx-cams.example/live  https://hot-adult-chat.example/en/8  http://warez-crack.example/download/keygen
https://free-cracks.example/serial  http://payday-loans-fast.example/apply  https://cheap-loans.example/en/3
http://replica-watches.example/sale  https://cheap-replica-bags.example/buy  http://fake-docs.example/passport
https://miracle-cure.example/buy-now
""".split()

ALLOW = """
https://www.city-library.example/en/catalogue/12  http://news.daily-herald.example/2021/05/story.html  https://blog.gardening.example/en/831
http://therewith.example/en/25  https://www.university.example/research/papers/7.html  https://docs.software.example/en/latest/api.html
http://m.weather.example/en/46  https://museum.example/exhibits/99  http://www.recipes.example/soup/lentil.html
https://blog.mathematics.example/proofs/4/  http://history.example/en/853/  https://www.travelguide.example/fr/214
http://nature.example/birds/17.html  https://forum.cycling.example/thread/5512?page=2  http://therein.example/de/311#top
https://m.thenth.example/en/17  http://blog.hereof.example/es/440?page=2&ref=x  https://www.hathere.example/en/9
http://oration.example/en/676  https://threshing.example/fr/438  http://www.stonehill.example/en/654#top
https://blog.thistle.example/es/575?utm_source=feed  http://m.eastern.example/en/885  https://theatre.example/en/234#top
http://www.mention.example/de/63  https://edition.example/en/70/  http://blog.nation.example/fr/86.html
https://astronomy.example/en/stars/31  http://www.poetry.example/en/poem/52  https://chess.example/en/opening/8
http://hospital.example/departments/4  https://www.schools.example/en/2  http://archive.letters.example/1890/3
https://m.rivers.example/en/5?utm_source=feed  http://hills.example/en/99#top  https://www.tinside.example/es/12
http://blog.other.example/en/519  https://wiki.plants.example/en/moss  http://code.example/project/readme.html
https://www.music.example/en/scores/6
""".split()

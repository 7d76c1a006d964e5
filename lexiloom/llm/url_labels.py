"""A small labelled url table: hosts and paths that a text corpus wants, and that it doesn't."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Labelled by hand.
UNWANTED = """
http://www.casino-royal.example.com/slots/1
https://casino-bonus.example.net/en/win
https://www.best-casino.example.org/jackpot
http://m.online-casino.example.com/play?id=4
http://poker-casino.example.com/en/free-spins
https://casino777.example.net/register
https://www.poker-stars-bonus.example.com/en/99
https://sports-betting.example.net/odds
https://www.bet-and-win.example.org/live-bets
http://slots-jackpot.example.com/en/12
https://lottery-winner.example.net/claim
https://m.buy-pills.example.net/viagra
https://pills-discount.example.org/de/3
http://cheap-viagra.example.com/order
https://online-pharmacy.example.net/no-prescription
https://www.pharmacy-cheap.example.org/cialis
https://cheap-meds.example.com/fr/77
http://weight-loss-pills.example.net/en/8
https://diet-pills.example.org/trial
https://adult-videos.example.com/watch/1
https://m.adult-dating.example.net/join
https://adult-chat.example.com/de/640
https://xxx-adult.example.net/gallery
http://free-xxx.example.org/video
https://www.porn-tube.example.com/en/14
https://sex-cams.example.net/live
https://hot-escorts.example.org/girls
https://nude-pics.example.com/fr/9
https://payday-loans.example.com/apply
http://cheap-loans.example.net/instant
https://www.quick-cash-loans.example.org/en/5
https://replica-watches.example.com/rolex
https://cheap-replica.example.net/bags
http://free-iphone-winner.example.org/claim-prize
https://crypto-doubler.example.com/invest
https://get-rich-quick.example.net/en/1
https://warez-crack.example.org/keygen
http://torrent-crack.example.com/download
https://spyware-free-download.example.net/exe
http://ad-tracking.example.net/pixel
https://bonus-bets.example.com/en/27
https://banner-popups.example.com/click
http://popup-clicks.example.org/en/banner
https://bulk-mailer.example.net/fr/41
http://backlink-seller.example.com/de/88
https://www.roulette-spins.example.net/es/6
https://blackjack-tables.example.org/fr/5.html
https://www.pharma-discount.example.com/en/450
https://erotic-clips.example.org/en/31
"""
WANTED = """
https://www.city-news.example.com/en/2021/council
https://news.example.org/world/12
https://blog.gardening.example.net/en/roses
https://docs.example.org/guide/install.html
https://en.encyclopedia.example.org/wiki/River
https://www.university.example.com/research/paper/4
http://library.example.net/catalog?page=2
https://recipes.example.com/de/suppe/88
https://www.museum.example.org/fr/expositions
http://weather.example.net/es/madrid
https://blog.travel.example.com/en/264#top
https://m.train-times.example.org/de/171
https://forum.linux.example.net/thread/929
https://support.example.com/en/articles/17
http://www.townhall.example.org/en/654
https://shop.books.example.net/fr/644
https://history.example.com/en/323.html
https://www.school.example.org/teachers
https://physics.example.net/lecture/notes
http://cinema.example.com/de/503
https://blog.photography.example.net/en/189
https://health.gov.example.org/vaccines
https://bank.example.com/en/contact
https://parks.example.net/trails/7
https://www.athletics.example.org/track-and-field
https://orchard.example.com/en/17
https://www.bakery.example.net/de/956
https://blog.astronomy.example.org/en/552?utm_source=feed
http://m.railway.example.com/fr/357?page=2&ref=x
https://pottery.example.net/es/970
https://www.choir.example.org/en/471
http://blog.cycling.example.com/en/104
https://botany.example.net/en/864?page=2&ref=x
https://m.hiking.example.org/en/518.html
https://www.hospital.example.com/es/319/
http://blog.sailing.example.net/de/945.html
https://grammar.example.org/fr/65
https://puzzles.example.com/en/48
https://m.cookbook.example.net/fr/510/
https://www.archive.example.org/de/571?utm_source=feed
https://blog.chemistry.example.com/en/912/
https://geology.example.net/en/234#top
https://volunteers.example.org/de/180#top
http://www.carpentry.example.com/en/843.html
"""


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url, label (1 unwanted, 0 wanted)."""
    rows = [(u, 1) for u in UNWANTED.split()] + [(u, 0) for u in WANTED.split()]
    literals = F.array(*(F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows))
    return spark.range(1).select(F.inline(literals))

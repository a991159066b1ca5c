"""A small labelled URL table for ``urls.fit_urls``: host, path and label (1 allow, 0 block)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# URLs labelled by hand. Hosts are under reserved or made-up names; both classes have as many of each top-level
# domain, so that the words of host and path tell them apart.
ALLOWED = """
encyclopedia.example.org/wiki/photosynthesis
encyclopedia.example.net/wiki/history_of_science
library.example.com/catalogue/books/4711
docs.example.org/manual/installation.html
docs.example.net/guide/getting-started
developer.example.com/reference/functions
news.example.org/world/article/2021/03/election
news.example.net/science/article/climate-report
journal.example.com/articles/volume-12/abstract
research.example.org/publications/paper-31
university.example.net/courses/mathematics
school.example.com/lessons/biology/cells
museum.example.org/collection/paintings
archive.example.net/texts/letters/1848
weather.example.com/forecast/coast
health.example.org/advice/vaccination
council.example.net/minutes/2020
recipes.example.com/bread/sourdough
blog.example.org/posts/garden-in-spring
blog.example.net/2019/07/travel-notes
forum.example.com/questions/8812/sorting-a-list
travel.example.org/guide/mountains
stories.example.net/chapter/3
wiki.example.com/page/river
magazine.example.org/essay/architecture
tutorial.example.net/python/loops
dictionary.example.com/define/harbour
maps.example.org/places/old-town
standards.example.net/documents/part-2
community.example.com/discussion/1022
"""
BLOCKED = """
casino-bonus.example.org/play/slots
online-casino.example.net/free-spins
poker-win.example.com/jackpot/register
betting-odds.example.org/bonus/signup
cheap-pills.example.net/buy/viagra
pharmacy-discount.example.com/order/pills-online
xxx-videos.example.org/hot/porn
adult-cams.example.net/live/sex
sexy-dating.example.com/singles/hot-girls
free-download.example.org/crack/keygen.exe
warez.example.net/torrent/full-cracked
torrent-movies.example.com/download/free
click-ads.example.org/track/redirect
adserver.example.net/banner/popup
tracker.example.com/pixel/click
payday-loans.example.org/apply/instant-cash
easy-money.example.net/earn/work-from-home
bitcoin-doubler.example.com/invest/profit
replica-watches.example.org/buy/cheap
cheap-handbags.example.net/sale/discount
shop-deals.example.com/cart/checkout
login-secure.example.org/account/verify/password
account-verify.example.net/signin/update
prize-winner.example.com/claim/gift-card
weight-loss.example.org/miracle/diet-pills
seo-links.example.net/buy/backlinks
parked-domain.example.com/for-sale
coupon-codes.example.org/promo/discount
spam-list.example.net/unsubscribe/offer
survey-reward.example.com/claim/prize
"""


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = []
    for label, urls in ((1, ALLOWED), (0, BLOCKED)):
        for url in urls.split():
            host, slash, path = url.partition("/")
            rows.append((host, slash + path, label))
    return spark.createDataFrame(rows, "host string, path string, label int")

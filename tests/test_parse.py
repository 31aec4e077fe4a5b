"""Raw lines of every layout, with the awkward ones."""

import re

from accesslens.operators import parse
from accesslens.operators.parse import accepted, rejected

TIME = "[01/Nov/2016:09:49:34 +0800]"
SEC = 1477964974
TAIL = "0.026 0.000 0.000 0.548 47.156 - 47.775 0.000 47.775"


def frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def one(df):
    rows = accepted(df).collect()
    assert len(rows) == 1, rows
    return rows[0]


def edge(ip="1.2.3.4", es="0.174", url="http://img.example.com/a/b.gif?x=1", refer="-", ua="curl/7.19", rest=None):
    rest = f" FCACHE_HIT_MEM  {TAIL} 1 - - 127.0.0.1 HIT 2073 5.6.7.8" if rest is None else rest
    return f'@|@c06.i06@|@LOG host-1 {ip} {es} - {TIME} "GET {url} HTTP/1.0" 200 2344 "{refer}" "{ua}"{rest}'


def test_full_line(spark, dims):
    r = one(parse.edge(frame(spark, edge()), dims))
    assert (r.machine, r.ip, r.isp, r.prv, r.domain, r.userid) == ("host-1", 16909060, "11", "8601", "img.example.com", "7")
    assert (r.url, r.suffix, r.status, r.cs, r.refer, r.ua, r.es) == ("img.example.com/a/b.gif", "gif", "200", 2344, "-", "other", 0.174)
    assert (r.hit, r.timestmp, r.ts_sec, r.dd) == ("FCACHE_HIT_MEM", "20161101014934", SEC, 1)
    assert (r.rk, r.up, r.Fa, r.Fv, r.platform, r.node) == ("-", "-", "127.0.0.1", "HIT", "c06.i06", "84281096")


def test_quoted_tail_is_cut_at_spaces(spark, dims):
    rest = f' IMS_HIT  {TAIL} "DISK HIT from 183.56.172.104, IMS MEM HIT from 61.130.28.14"'
    r = one(parse.edge(frame(spark, edge(rest=rest)), dims))
    assert (r.dd, r.rk, r.up, r.Fa, r.Fv, r.node) == (0, "HIT", "from", "183.56.172.104,", "IMS", "0")


def test_line_that_ends_early(spark, dims):
    short = one(parse.edge(frame(spark, edge(rest=' "-" 1.193.188.45')), dims))
    assert (short.hit, short.dd, short.rk, short.node) == ('"-"', 0, "-", "29473837")
    bare = one(parse.edge(frame(spark, edge(rest="")), dims))
    assert (bare.hit, bare.Fv, bare.node) == ("-", "-", "0")
    unclosed = one(parse.edge(frame(spark, edge(rest="")[:-1]), dims))
    assert (unclosed.hit, unclosed.ua) == ("unkown", "other")


def test_a_number_that_ends_the_line_is_no_dd(spark, dims):
    assert one(parse.edge(frame(spark, edge(rest=f" HIT {TAIL} 5")), dims)).dd == 0


def test_enveloped_client_and_referer_host(spark, dims):
    r = one(parse.edge(frame(spark, edge(ip="@|@Q000@|@1.2.3.4", refer="http://www.163.com/x", es="-")), dims))
    assert (r.ip, r.refer, r.es) == (16909060, "www.163.com", 0.0)


def test_wildcard_owner(spark, dims):
    r = one(parse.edge(frame(spark, edge(url="http://a.cdn.example.org/x.m3u8")), dims))
    assert (r.domain, r.userid, r.suffix) == ("ext.cdn.example.org", "9", "m3u8")


def test_loopback_rules(spark, dims):
    for ip in ("127.0.0.1", "127.0.1.1"):
        parsed = parse.edge(frame(spark, edge(ip=ip)), dims)
        assert accepted(parsed).count() == 0 and rejected(parsed).count() == 0
    assert accepted(parse.machine(frame(spark, edge(ip="127.0.0.1"), edge(ip="127.0.1.1")), dims)).count() == 1


def test_rejects(spark, dims):
    bad = [
        edge().replace(TIME, "-"), edge(url="http://nobody.org/x"), edge(es="abc"), edge(ip="1.2.3"), edge(refer=""),
        edge().replace(" 2344 ", " x "), edge().replace('" 200', '"  200 1'), "", "word",
    ]
    parsed = parse.edge(frame(spark, *bad), dims)
    assert accepted(parsed).count() == 0
    assert sorted(r.value for r in rejected(parsed).collect()) == sorted(bad)


def test_machine_row(spark, dims):
    rest = f" FCACHE_MISS {TAIL} 0 - 10.9.9.9 1.1.1.1 HIT x 5.6.7.8"
    line = edge(es="100", rest=rest).replace(" 2344 ", " 2344000 ")
    r = one(parse.machine(frame(spark, line), dims))
    assert (r.hit_type, r.speed, r.zero_speed, r.platform, r.pop_id, r.machine_isp_code) == (1, 0, 1, "c01", 203, 12)


def powza(host="live.example.net"):
    return (
        f'LOG_POWZA_cache host-1 1478758501.000 1.2.3.4 - - {TIME} 200 872 http://{host}/ 81 GET '
        f'http://{host}:80/cache/69/index.M3U8?a=b "Mozilla/4.0 (Windows NT 6.2)" "-" - "http://x/" 111.111.111.111'
    )


def test_powza(spark, dims):
    r = one(parse.powza(frame(spark, powza()), dims))
    assert (r.domain, r.url, r.suffix, r.ua, r.es, r.hit) == (
        "live.example.net", "live.example.net:80/cache/69/index.M3U8", "m3u8", "windows", 0.0, "unkown",
    )
    b = one(parse.powza_billing(frame(spark, powza()), dims))
    assert (b.es, b.cs, b.node, b.area_pid, b.ts_sec) == (81.0, 872, 1869573999, "1000", SEC)


MEDIA = (
    f"LOG_MEDIA_cache host-1 fast rtmp {TIME} 13071_1 rtmp://live.example.net/ app 2df5 178.209.0.1 125.39.172.164 play "
    '"rtmp://x/y" "" 0 1605756 5 11 "streaming:status" "" "WIN 22,0,0,168" - - - - - (3m 1s) 125.39.172.164'
)


def test_media(spark, dims):
    r = one(parse.media_billing(frame(spark, MEDIA), dims))
    assert (r.domain, r.status, r.es, r.cs, r.isp, r.area_pid) == ("live.example.net", "0", 0.0, 1605756, "12", "0")


def test_dispatch_equals_single_parsers(spark, dims):
    mixed = parse.dispatch_billing(frame(spark, edge(), powza(), MEDIA, "junk", "one word"), dims)
    want = [
        one(parse.edge_billing(frame(spark, edge()), dims)),
        one(parse.powza_billing(frame(spark, powza()), dims)),
        one(parse.media_billing(frame(spark, MEDIA), dims)),
    ]
    assert sorted(accepted(mixed).collect()) == sorted(want)
    assert rejected(mixed).count() == 2
    wide = accepted(parse.dispatch_access(frame(spark, edge(), powza()), dims)).collect()
    assert sorted(r.machine for r in wide) == ["host-1", "host-1"]


def hashed(head="LOG cnc-jl-175-022-002-182 img.example.com", ip="1.2.3.4", url="/vip/a.zip", last="14532 122.192.111.135", es="0.001"):
    fields = [head, ip, "-", TIME, f"GET {url} HTTP/1.1", "200", "14042", "-", "curl/7", es, "0.001", "9.9.9.9", "TCP_HIT -", "agent", last]
    return "#_#".join(fields)


def test_hash_lines(spark, dims):
    r = one(parse.hash_v2(frame(spark, hashed(es="x")), dims))
    assert (r.domain, r.url, r.suffix, r.cs, r.es, r.hit, r.node) == ("img.example.com", "/vip/a.zip", "zip", 14532, 0.0, "TCP_HIT", "2937455286")
    secure = one(parse.hash_v2(frame(spark, hashed(last="14532#_#https 1.1.1.1")), dims))
    assert (secure.domain, secure.userid) == ("https_img.example.com", "7")
    wrapped = hashed(head="@|@c@|@68@|@P@|@LOG cnc-jl-175-022-002-182 @|@000@|@img.example.com")
    assert one(parse.hash_v2(frame(spark, wrapped), dims)).domain == "img.example.com"
    v1 = one(parse.hash_v1(frame(spark, hashed(url="http://img.example.com/a/b.js?q")), dims))
    assert (v1.url, v1.suffix) == ("img.example.com/a/b.js", "js")


def test_hash_rejects_keep_the_line(spark, dims):
    bad = [hashed(ip="127.0.0.1"), hashed(head="LOG x img.example.com"), hashed(head="LOG cnc-jl-1-2-3-4 nobody.org"), "junk"]
    parsed = parse.hash_v2(frame(spark, hashed(), *bad), dims)
    assert accepted(parsed).count() == 1
    assert sorted(r.value for r in rejected(parsed).collect()) == sorted(bad)


def test_hash_directories(spark):
    r = one(parse.hash_dir(frame(spark, hashed(url="http://h/icons/x.png", last="1620 21"))))
    assert (r.domain, r.dir, r.timestamp, r.flow_size, r.https_flag) == ("img.example.com", "/icons", SEC // 300 * 300 + 300, 1620, "http")
    assert accepted(parse.hash_dir(frame(spark, hashed(url="/"), hashed(ip="127.0.0.1")))).count() == 0


JSON = (
    '{"es":46.194,"tl":{"value":8.047,"representation":"s"},"rm":"GET","Fs":200,"ori":"a \\"b\\"","st":"MISS","hostname":"h",'
    '"ru":"http://img.example.com/i/x.png","ua":"Chrome","rv":"HTTP/1.1","rf":"-","a":"1.2.3.4","cs":590,"lt":1.452581275E18}'
)


def test_quoted_text_where_text_belongs(spark, dims):
    status, other = JSON.replace('"Fs":200', '"Fs":"200x"'), JSON.replace("{", '{"extra":{"value":"5"},', 1)
    assert status != JSON
    assert [r.Fs for r in accepted(parse.json(frame(spark, status, other), dims)).select("Fs").collect()] == ["200x", "200"]
    assert accepted(parse.json_strict(frame(spark, status, other), dims)).count() == 1
    for quoted in ('"cs":"', '"es":"', '"lt":"'):
        key = quoted[:-1]
        line = re.sub(key + r"([0-9.eE+]+)", quoted + r'\1"', JSON)
        assert line != JSON and rejected(parse.json(frame(spark, line), dims)).count() == 1


def test_json(spark, dims):
    r = one(parse.json(frame(spark, JSON), dims))
    assert (r.domain, r.Fs, r.cs, r.tl, r.ua, r.suffix, r.timestampLong) == ("img.example.com", "200", 590, 8.047, "pc", "png", 1452581275)
    assert one(parse.json_strict(frame(spark, JSON), dims)).timestamp == "20160112064755"
    partial = JSON.replace('"cs":590,', "").replace('"es":46.194,', "")
    r = one(parse.json(frame(spark, partial), dims))
    assert (r.cs, r.es) == (0, 0.0)
    assert accepted(parse.json_strict(frame(spark, partial), dims)).count() == 0
    bad = [JSON.replace("1.2.3.4", "1.2.3.4 _jsonparsefailure"), JSON.replace("example.com/i", "nobody.org/i"), "{broken"]
    assert rejected(parse.json(frame(spark, *bad), dims)).count() == 3


def slow(ip="16.0.0.0", es="1058", cs="2222772", status="200", host="kwmov.a.yximgs.com", node="1.0.0.9"):
    return f'LOG_cache host-1 {ip} {es} 0 {TIME} "GET http://{host}/u/x.mp4?tag=1 HTTP/1.1" {status} {cs} "-" "agent" mem 0.000 {node}'


def test_slow_rate(spark, dims):
    r = one(parse.slow_rate(frame(spark, slow(ip="1.2.3.4")), dims.named))
    assert (r.domain, r.host, r.isp, r.province, r.ifSlow) == ("kwmov.a.yximgs.com", "host-1", "ONE", "P1", 0)
    assert one(parse.slow_rate(frame(spark, slow(es="99999")), dims.named)).ifSlow == 1
    assert one(parse.slow_rate(frame(spark, slow(ip="179.0.0.1")), dims.named)).isp == "other"
    wrapped = slow().replace("LOG_cache host-1 ", "@|@c@|@17@|@P@|@LOG_cache host-1 @|@000@|@")
    assert one(parse.slow_rate(frame(spark, wrapped), dims.named)).host == "host-1"


def test_slow_rate_drops_and_rejects(spark, dims):
    drops = [slow(ip="127.0.0.1"), slow(es="-"), slow(host="x.org"), slow(status="404"), slow(status="502"), slow(cs="-"), slow(cs="262143")]
    bad = [slow(es="x"), slow(cs="x"), slow(ip="1.2"), slow(node="x"), slow().replace(TIME, "-"), ""]
    parsed = parse.slow_rate(frame(spark, *drops, *bad), dims.named)
    assert accepted(parsed).count() == 0
    assert sorted(r.value for r in rejected(parsed).collect()) == sorted(bad)


def test_trim_and_extract(spark):
    with_host = hashed(url="http://w5.example.com/do/x.jpg")
    no_path = hashed(url="http://w5.example.com").replace(" HTTP/1.1", "")
    odd = [hashed(), with_host, no_path, "no separator"]
    got = [r.value for r in parse.trim_request_host(frame(spark, *odd)).collect()]
    assert got == [hashed(), hashed(url="/do/x.jpg")]
    assert [r.value for r in parse.extract_original(frame(spark, JSON, "{}")).collect()] == ['a "b"']
    assert [r.value for r in parse.extract_original(frame(spark, JSON, "{}"), raw=True).collect()] == ['a \\"b\\"']


FORMAT = r'%>a %es %ss [%lt] \"%rm %ru %rv\" %Fs %cs \"%rf\" \"%ua\" %st %tl %dd %rk %up %Fa %Fv'


def test_format_string(spark):
    assert parse.format_positions(FORMAT)["tl_es"] == 19
    line = (
        '127.0.0.1 0.074 - [09/Apr/2015:10:09:07 +0800] "PURGE http://h/x HTTP/1.0" 404 294 "-" "-" FCACHE_MISS  '
        '0.000 0.000 - - - - 0.000 0.074 0.074 0 - - [127.0.0.1] "[MISS from 118.123.114.156]"'
    )
    r = parse.by_format(frame(spark, line), FORMAT).collect()[0]
    assert (r.ip, r.lt, r.rm_ru_rv, r.st) == ("127.0.0.1", "09/Apr/2015:10:09:07 +0800", "PURGE http://h/x HTTP/1.0", "FCACHE_MISS")
    assert (r.tl_es, r.dd, r.rk, r.up, r.fa, r.fv) == ("0.074", "0", "-", "-", "127.0.0.1", "[MISS from 118.123.114.156]")

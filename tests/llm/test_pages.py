import gzip
import hashlib
import io
import random

import pytest


from hindcast.llm.arc_warc import archived, arc_records, convert, read_warc
from hindcast.llm.html_trees import MARK, Composer, Tree, extract, texts_of, trained

from llm_helpers import SF, prose

PAGES = "page_id long, url string, html string, kind string, digest int"


def page(rng, main, junk=""):
    return f"<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>{junk}<article>{main}</article><footer>&copy; all</footer></body></html>"


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(3)
    same = page(rng, f"<p>{prose(rng, 300)}</p>")
    rows = [(i, f"http://h{i % 3}/ a\t{i}", page(rng, f"<h1>T {i}</h1><p>{prose(rng, 40)}</p>")) for i in range(30)]
    rows += [(i, None if i % 2 else "", same) for i in range(100, 160)]
    rows += [(200, "http://x/", None), (201, "http://x/", ""), (202, "http://x/", "é" * 499), (203, "http://x/", "é" * 499),
             (204, "http://x/", "é" * 500), (205, "http://x/", "é" * 500), (None, "http://n/", same), (None, "http://n/", "y" * 2000),
             (300, "http://l/", "<p>" + "long text " * 200_000), (159, None, same), (206, "http://x/", "\r\n\r\nWARC/1.0\r\n\r\n" * 90)]
    return rows, spark.createDataFrame([(*r, "k", 1) for r in rows], PAGES)


def test_archives_round_trip(pages):
    rows, table = pages
    found = archived(table.repartition(5)).collect()
    assert len(found) == len(rows)
    best = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            best[data] = max(best.get(data, -1), -1 if i is None else i)
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        top = best.get(data, -1)
        again = top > (-1 if i is None else i)
        expected.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert archived(table.where("false")).count() == 0


def test_both_arc_versions_and_gzip_members(spark, tmp_path):
    first = b"filedesc://a.arc 0.0.0.0 19990101000000 text/plain 77\n1 0 Old\nURL IP-address Archive-date Content-type Archive-length\n"
    head, _, body = first.partition(b"\n")
    head = head.rsplit(b" ", 1)[0] + b" " + str(len(body)).encode()
    one = b"http://a/x y 1.2.3.4 19990102030405 text/html 11\nhello world"
    dns = b"dns:a 1.2.3.4 19990102030406 text/dns 3\nabc"
    columns = b"2 0 Old\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    two = b"filedesc://b.arc 0.0.0.0 20010101000000 text/plain 200 - - 0 b.arc " + str(len(columns)).encode() + b"\n" + columns
    message = b"HTTP/1.0 200 OK\r\nX: y\r\n\r\n\x00\xff\nbinary"
    three = b"http://b/ 1.2.3.4 20010102030405 image/gif 200 - - 99 b.arc " + str(len(message)).encode() + b"\n" + message
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.arc").write_bytes(b"\n".join([head + b"\n" + body, one, dns, b""]))
    (tmp_path / "in/b.arc.gz").write_bytes(b"".join(gzip.compress(x + b"\n") for x in (two, three)))
    convert(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = {r["url"]: r for r in read_warc(spark, str(tmp_path / "out")).collect()}
    assert {k: r["kind"] for k, r in rows.items()} == {None: "warcinfo", "http://a/x y": "resource", "dns:a": "resource", "http://b/": "response"}
    assert rows["http://a/x y"]["date"] == "1999-01-02T03:04:05Z" and bytes(rows["http://a/x y"]["payload"]) == b"hello world"
    assert bytes(rows["http://b/"]["payload"]) == b"\x00\xff\nbinary"
    assert rows["http://b/"]["digest"] == hashlib.sha1(b"\x00\xff\nbinary").hexdigest()
    with pytest.raises(ValueError):
        list(arc_records(io.BytesIO(head + b"\n" + body + b"\nhttp://a/ 1.2.3.4 19990102030405 text/html 50\nshort")))


def test_extracts_the_article(spark, pages):
    rows, table = pages
    found = {(r["page_id"], r["url"]): r for r in extract(table).collect()}
    for i, url, html in rows[:30]:
        main = html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(x.split()) for x in main.replace("<h1>", "\n").replace("</h1>", "\n").replace("<p>", "\n").replace("</p>", "\n").split("\n")]
        text = "\n\n".join(x for x in blocks if x)
        assert found[i, url]["text"] == text and found[i, url]["n_chars"] == len(text)
    assert extract(table).count() == len(rows) and found[200, "http://x/"]["text"] == found[201, "http://x/"]["text"] == ""
    assert extract(table.where("false")).count() == 0


def test_composed_pages_held_out(spark):
    htmls = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").limit(40).collect()]
    trees = trained(htmls)
    composer = Composer([w for h in htmls for n in Tree(h).nodes if n.text for w in n.text.split()], 77)
    wanted = right = given = 0
    for _ in range(150):
        html = composer.page()
        main = [n.text.replace(MARK, "").strip() for n in Tree(html).nodes if n.text and MARK in n.text]
        got = texts_of([html.replace(MARK, "")], trees)[0].split("\n\n")
        wanted += sum(map(len, main))
        given += sum(map(len, got))
        right += sum(len(x) for x in got if x in set(main))
    assert right / wanted > 0.97 and right / given > 0.97


def test_blocks_references_and_white_space():
    tree = Tree("<body>a&amp;b <b>c</b>\n\td<p>e<p>f&nbsp;&#x41;<br>g</p><ul><li>h<li>i</ul><!-- no --><style>p{}</style><table><tr><td>j<td>k</table><div>l<span>m</span></div>n")
    assert [n.text for n in tree.nodes if n.text] == ["a&b c d", "e", "f A g", "h", "i", "j", "k", "lm", "n"]
    assert Tree("").nodes[0].words == 0 and Tree("<div><p>open").nodes[-1].text == "open"


def test_no_contradictions():
    tree = Tree("<div><p>a</p><p>b</p></div><p>c</p>")
    assert tree.decoded(tree.features()[:, 0] * 0 - 1) == []
    odds = tree.features()[:, 0] * 0 + 5
    odds[1] = -1
    assert tree.decoded(odds) == ["c"]


@pytest.mark.parametrize("markup", [
    "<body><form><select><option>gone<option>gone</select></form>{}", "<body><form><select><option>gone</form>{}",
    "<body><select><optgroup><option>gone<optgroup><option>gone</select>{}", "<body><p><span><select><option>gone</span>{}",
    "<head><title>gone</title><body>{}", "<head><title>gone</title>{}", "<head><noscript><link>{}", "<head><meta>bare {}",
    "<body><div><noscript>gone</div>{}", "<body><div><object><p>gone</p></div>{}", "<body><div><canvas>gone</div>{}",
    "<body><div><template><div>gone</div></div>{}", "<body><svg><g><text/><path></g></svg>{}", "<body><select><option>gone<input>{}",
    "<body><object><div>gone</div></object>{}", "<body><video><source>gone</video>{}</body>",
])
def test_text_after_open_invisible_elements_is_kept(markup):
    said = " ".join(n.text for n in Tree("<html>" + markup.format("<p>the article</p><p>its end</p>")).nodes if n.text)
    assert said.endswith("the article its end") and "gone" not in said

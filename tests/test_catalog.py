from trackline.sources import catalog

PAGE = ('<html><a href="2024/">2024/</a> <a href="2023/">2023/</a>'
        '<pre><a href="AIS_2024_01_05.zip">AIS_2024_01_05.zip</a>   123.4M</pre>'
        '<pre><a href="AIS_2024_Zone03_07.zip">x</a> 1.5G</pre>'
        '<pre><a href="AIS_2024_GulfCoast.zip">x</a></pre>'
        '<pre><a href="readme.txt">readme</a> 456K</pre>'
        '<pre><a href="notes_2024.zip">x</a> 9K</pre></html>')


def _pages(spark):
    return spark.createDataFrame([(1, "https://example.invalid/", PAGE)], "page_id long, url string, html string")


def test_years_files_sizes(spark):
    pages = _pages(spark)
    assert [r["year"] for r in catalog.index_years(pages).collect()] == ["2024", "2023"]
    files = {r["filename"]: r for r in catalog.index_files(pages).collect()}
    assert set(files) == {"AIS_2024_01_05.zip", "AIS_2024_Zone03_07.zip", "AIS_2024_GulfCoast.zip"}
    d, z, g = files["AIS_2024_01_05.zip"], files["AIS_2024_Zone03_07.zip"], files["AIS_2024_GulfCoast.zip"]
    assert (d["type"], d["month"], d["day"], d["size_bytes"]) == ("daily", 1, 5, int(123.4 * 1024 ** 2))
    assert (z["type"], z["zone"], z["sequence"], z["size_bytes"]) == ("zone", "03", "07", int(1.5 * 1024 ** 3))
    assert (g["type"], g["region"], g["size_bytes"]) == ("regional", "GulfCoast", None)
    sizes = {r["href"]: r["size_bytes"] for r in catalog.size_to_bytes(pages).collect()}
    assert sizes["readme.txt"] == 456 * 1024


def test_listing_select_urls(spark):
    files = catalog.index_files(_pages(spark))
    listing = catalog.archive_listing(files, max_files=2).collect()
    assert [r["filename"] for r in listing] == ["AIS_2024_GulfCoast.zip", "AIS_2024_Zone03_07.zip"]
    assert listing[1]["size_display"] == "1.5 GB" and listing[1]["details"] == "Zone: 03, Sequence: 07"
    assert listing[0]["size_display"] == "unknown" and listing[0]["more_files"] == 1
    assert listing[0]["listed_known_bytes"] == int(1.5 * 1024 ** 3) and listing[0]["listed_total_display"] == "1.5 GB"
    pick = catalog.archive_select(files, position=3).collect()
    assert pick[0]["filename"] == "AIS_2024_01_05.zip"
    req = spark.createDataFrame([("2024", None), ("2023", "Zone10_02")], "year string, zone string")
    urls = [r["url"] for r in catalog.archive_urls(req, "https://h/").collect()]
    assert urls == ["https://h/2024/AIS_2024_01_01.zip", "https://h/2023/AIS_2023_Zone10_02.zip"]


def test_links_as_a_browser_sees_them(spark):
    html = ("<!-- <a href=commented.zip>x</a> 1K --><script>var s = '<a href=\"scripted.zip\">';</script>"
            "<table><tr><td><a class=x href='AIS_2024_01_02.zip'>AIS_2024_01_02.zip</a></td>\n<td align=\"right\">12.5M</td></tr></table>"
            "<A\n  title='2 > 1' HREF = \"../2023/AIS_2023_01_03.zip?x=1&amp;y=2\"><b>t</b></A> 3 GB <a href=/ais/AIS_2022_02_02.zip>a<a href=\"//other.example/2021/\">b"
            "</a>7K<a name=n>no link</a><a href=\"https://[bad/AIS_2020_01_01.zip\">c</a>" + "<a " + "x=\"1\" " * 20_000 + "href=many.zip>d</a>")
    pages = spark.createDataFrame([(1, "https://host.example/ais/2024/index.html?q#f", html), (2, None, None), (3, None, "<a href='r.zip'>")],
                                  "page_id long, url string, html string")
    got = [(r.href, r.filename, r.url, r.size_text, r.size_bytes) for r in catalog.links(pages).collect()]
    assert got == [
        ("AIS_2024_01_02.zip", "AIS_2024_01_02.zip", "https://host.example/ais/2024/AIS_2024_01_02.zip", "12.5M", int(12.5 * 2 ** 20)),
        ("../2023/AIS_2023_01_03.zip?x=1&y=2", "AIS_2023_01_03.zip", "https://host.example/ais/2023/AIS_2023_01_03.zip?x=1&y=2", "3G", 3 * 2 ** 30),
        ("/ais/AIS_2022_02_02.zip", "AIS_2022_02_02.zip", "https://host.example/ais/AIS_2022_02_02.zip", None, None),
        ("//other.example/2021/", "2021/", "https://other.example/2021/", "7K", 7168),
        ("https://[bad/AIS_2020_01_01.zip", "AIS_2020_01_01.zip", None, None, None),
        ("many.zip", "many.zip", "https://host.example/ais/2024/many.zip", None, None), ("r.zip", "r.zip", "r.zip", None, None)]
    assert [r.year for r in catalog.index_years(pages).collect()] == ["2021"]

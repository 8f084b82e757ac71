"""Small dirty Bronze files of the reference's shapes, written with the standard library."""

import io
import json
import os
import zipfile


def _xlsx(rows_by_sheet):
    """A minimal .xlsx: shared strings for text, numbers inline."""
    strings, index = [], {}

    def sid(s):
        if s not in index:
            index[s] = len(strings)
            strings.append(s)
        return index[s]

    def col(i):
        s = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            s = chr(65 + r) + s
        return s

    sheets = []
    for rows in rows_by_sheet:
        xml_rows = []
        for r_i, row in enumerate(rows, start=1):
            cells = []
            for c_i, v in enumerate(row):
                ref = f"{col(c_i)}{r_i}"
                if v is None:
                    continue
                if isinstance(v, (int, float)):
                    cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                else:
                    cells.append(f'<c r="{ref}" t="s"><v>{sid(str(v))}</v></c>')
            xml_rows.append(f'<row r="{r_i}">{"".join(cells)}</row>')
        sheets.append('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/'
                      'spreadsheetml/2006/main"><sheetData>' + "".join(xml_rows) + "</sheetData></worksheet>")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        for i, sx in enumerate(sheets, start=1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", sx)
        sst = "".join(f"<si><t>{s}</t></si>" for s in strings)
        z.writestr("xl/sharedStrings.xml", '<?xml version="1.0"?><sst xmlns="http://schemas.openxmlformats.org/'
                   f'spreadsheetml/2006/main">{sst}</sst>')
    return buf.getvalue()


def write_bronze(root: str) -> None:
    def w(rel, data, mode="w"):
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, mode) as fh:
            fh.write(data)

    cust = ["Customer Id,  Full Name ,Email Address,Sign Up Date,Country"]
    for i in range(1, 11):
        d = f"2026-0{1 + i % 5}-1{i % 9}" if i % 2 else f"1{i % 9}/0{1 + i % 5}/2026"
        cust.append(f"C{i:03d},  Name {i} ,c{i}@x.org,{d},{'DE' if i % 2 else 'FR'}")
    cust.append(cust[3])                     # exact duplicate row
    w("retail/customers_20260601.csv", "\n".join(cust) + "\n")

    orders = [["Order No", "Cust Id", "Order Dt", "Order Total", "Order Status"]]
    for i in range(1, 16):
        total = "N/A" if i == 7 else round(10.5 * i, 2)
        d = f"2026-06-{i:02d}" if i % 2 else f"06/{i:02d}/2026"
        orders.append([f"O{i:03d}", f"C{1 + i % 12:03d}", d, total, "SHIPPED" if i % 3 else "shipped"])
    w("retail/orders_20260603.xlsx", _xlsx([orders, []]), "wb")

    fb = ["Timestamp,What is your Customer ID?,How satisfied are you (1-5)?,Any additional comments?"]
    for i in range(1, 9):
        fb.append(f"2026-06-0{i} 10:00:00,C{i:03d},{1 + i % 5},{'' if i % 3 == 0 else 'ok ' + str(i)}")
    w("retail/feedback_20260605.csv", "\n".join(fb) + "\n")

    w("random_export_2026.csv", "a,b,c\n" + "\n".join(f"{i},x{i},{i * 1.5}" for i in range(6)) + "\n")

    students = [{"roll_no": f"S{i}", "name": f"Student {i}", "date of birth": f"2001-0{1 + i % 9}-15",
                 "dept": "CS" if i % 2 else "EE", "email address": f"s{i}@u.edu"} for i in range(1, 7)]
    w("education/students_20260602.json", json.dumps(students))

    recs = "".join(f"<record><roll_no>S{1 + i % 6}</roll_no><course_code>C{i % 3}</course_code>"
                   f"<final_grade>{'AB'[i % 2]}</final_grade><points>{i % 4 + 1}</points>"
                   f"<credit_hours>{3 + i % 2}</credit_hours></record>" for i in range(10))
    w("education/grades_20260604.xml", f"<?xml version='1.0'?><grades>{recs}</grades>")

    t = ["Case ID, Contact Email ,Title,Severity,Opened At,Closed At,Ticket Status"]
    for i in range(1, 9):
        closed = "" if i % 3 == 0 else f"2026-06-{i + 1:02d} 12:00:00"
        t.append(f"T{i},  a{i}@x.org ,Issue {i},{'HIGH' if i % 2 else 'low'},2026-06-0{i} 09:00:00,{closed},open")
    t.append(",,,,,,")
    t.append(t[2])
    w("support/tickets_20260607.csv", "\n".join(t) + "\n")

    agents = [{"agent no": f"A{i}", "name": f"Agent {i}", "department": "L1", "start_date": "2025-01-0" + str(i)}
              for i in range(1, 4)]
    w("support/agents_20260601.json", json.dumps(agents))
    w("support/ticket_attachment_20260608.png", b"\x89PNG\r\n\x1a\n" + bytes(range(64)), "wb")

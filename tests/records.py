"""Ten small marked texts of our own, in the two forms that the parser takes."""

PEOPLE = [
    ("Ada Brook", "Data Engineer", "SQL | Data; Python | Programming; C++ | Programming", "Harbor Labs", "Mill & Co", "SQL, Kafka"),
    ("Ben Okoro", "Analyst", "Excel | Office; sql | Data\nPower BI | Data", "Harbor Labs", "Stone.io", "Excel, R"),
    ("Cleo Marin", "Nurse", "Triage | Care; Excel", "City Clinic", "North Ward", ""),
]


def document(name, title, skills, first, second, tech, links=True):
    head = [f"# {name}", f"Email: {name.split()[0].lower()}@example.test", "Phone:", "Location: Hill Town"]
    head += ["LinkedIn: https://l.example/x", "Portfolio: https://p.example/x"] if links else []
    head += [f"Headline: {title}"]
    return "\n".join(head) + f"""

[SUMMARY]
{title} with years
of practice.

[SKILLS]
{skills}

[EXPERIENCE]
{title} | {first} | Hill Town | 2020-01 | Present | Did things | and more.
Junior {title} | {second} | Hill Town | 2018-01 | 2019-12
 | Nobody | here

[EDUCATION]
B.Sc. | Hill University | Hill Town | 2017
| No Degree College | x | y

[PROJECTS]
Tool of {name} | {tech} | A tool |

[CERTIFICATIONS]
Paper | Board | 2021
No issuer

[LANGUAGES]
English | Native; Welsh
"""


TEXTS = [(f"{k:02d}_{p[0].split()[0].lower()}.{'md' if k % 2 else 'txt'}", document(*p, links=k != 2)) for k, p in enumerate(PEOPLE)]

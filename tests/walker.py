"""The plain walk of a document, which the flattening expression is held against."""

import xml.etree.ElementTree as ET


def flatten_document(xml_text):
    """Document -> ordered (element, attribute, value) triples."""
    out = []
    for el in ET.fromstring(xml_text).iter():
        if el.text and el.text.strip():
            out.append((el.tag, "text", el.text))
        out += [(el.tag, k, v) for k, v in el.attrib.items()]
    return out

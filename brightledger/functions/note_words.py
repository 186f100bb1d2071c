"""The words of note categories, their subcategories, and statements, in the order in which ties are decided."""

from __future__ import annotations

NOTE_CATEGORIES = {
    "회계정책": ("회계정책", "회계처리방법", "회계기준", "회계정책과 공시의 변경", "재무제표 작성기준", "회계정책의 변경", "회계처리방침"),
    "재무상태": ("자산", "부채", "자본", "유동자산", "비유동자산", "유동부채", "비유동부채", "현금및현금성자산", "매출채권", "재고자산", "유형자산", "무형자산"),
    "손익계산": ("매출", "수익", "매출원가", "판매비", "관리비", "영업이익", "당기순이익", "매출총이익", "영업외수익", "영업외비용", "법인세비용"),
    "현금흐름": ("현금흐름", "현금흐름표", "영업활동현금흐름", "투자활동현금흐름", "재무활동현금흐름", "현금및현금성자산의 증감"),
    "자본변동": ("자본변동", "자본변동표", "자본금", "자본잉여금", "이익잉여금", "기타포괄손익", "자본거래", "배당"),
    "관련자거래": ("관련자", "관련회사", "관련자거래", "지배기업", "종속기업", "연결회사", "관련자와의 거래", "관련자 거래"),
    "우발부채": ("우발부채", "우발사항", "보증", "담보", "소송", "분쟁", "계약상 의무", "우발부채 및 우발자산"),
    "사업부문": ("사업부문", "부문별", "사업부문별", "부문별 정보", "사업부문 정보", "DX부문", "DS부문", "Device eXperience", "Device Solutions"),
    "리스크관리": ("위험", "리스크", "위험관리", "신용위험", "시장위험", "유동성위험", "운영위험", "법적위험", "규제위험"),
    "감사정보": ("감사", "감사인", "감사보고서", "감사의견", "감사위원회", "내부회계관리제도", "감사비용", "감사인 선임"),
    "기타": ("기타", "일반", "기타사항", "기타 정보", "추가 정보"),
}
NOTE_SUBCATEGORIES = {
    "회계정책": {
        "기준": ("한국채택국제회계기준", "K-IFRS", "회계기준", "기준서"),
        "변경": ("회계정책의 변경", "기준서 개정", "신규 적용", "변경사항"),
        "추정": ("회계추정", "추정치", "가정", "판단", "추정의 변경"),
    },
    "재무상태": {
        "자산": ("현금", "매출채권", "재고자산", "유형자산", "무형자산", "투자자산"),
        "부채": ("매입채무", "차입금", "사채", "충당부채", "퇴직급여충당부채"),
        "자본": ("자본금", "자본잉여금", "이익잉여금", "기타포괄손익"),
    },
    "손익계산": {
        "수익": ("매출", "수익", "매출원가", "매출총이익"),
        "비용": ("판매비", "관리비", "연구개발비", "감가상각비"),
        "이익": ("영업이익", "당기순이익", "법인세비용"),
    },
    "현금흐름": {
        "영업": ("영업활동현금흐름", "영업현금흐름"),
        "투자": ("투자활동현금흐름", "투자현금흐름"),
        "재무": ("재무활동현금흐름", "재무현금흐름"),
    },
    "자본변동": {
        "자본거래": ("자본금", "자본잉여금", "자본거래"),
        "이익분배": ("배당", "이익분배", "배당금"),
        "기타포괄손익": ("기타포괄손익", "OCI", "기타포괄손익누계액"),
    },
}
NO_SUBCATEGORY = "기타"

#: Words of each statement's tables. One that stands twice counts twice.
STATEMENT_WORDS = {
    "BS": (
        "자산", "부채", "자본", "재무상태표", "balance sheet", "유동자산", "비유동자산", "유동부채", "비유동부채", "현금및현금성자산", "매출채권",
        "재고자산", "유형자산", "무형자산", "단기차입금", "매입채무", "장기차입금", "사채", "이익잉여금",
    ),
    "CF": (
        "현금", "흐름", "영업활동", "투자활동", "재무활동", "cash flow", "현금흐름표", "현금의 증가", "현금의 감소", "영업에서 창출된 현금",
        "투자활동으로 인한 현금흐름", "재무활동으로 인한 현금흐름", "현금 및 현금성자산의 순증가", "현금영업이익", "현금영업손실", "현금영업활동",
        "현금투자활동", "현금재무활동", "현금흐름", "영업현금흐름", "투자현금흐름", "재무현금흐름",
    ),
    "EQ": (
        "자본변동", "equity", "변동표", "자본금", "주식발행", "이익잉여금", "기타자본항목", "자본변동표", "주주자본", "자본총계", "자본변동내역",
        "주식발행전환사채", "신종자본증권", "자본조정", "자본거래", "자본변동사항", "주주지분", "자기주식", "자기주식의 취득", "자기주식의 처분",
        "주식매수선택권", "주식보상비용", "기타자본조정",
    ),
    "CI": (
        "포괄손익", "기타포괄손익", "comprehensive income", "포괄손익계산서", "기타포괄손익누계액", "당기순이익", "기타포괄손익", "총포괄손익",
        "포괄손익계산서상 당기순이익", "기타포괄손익 합계",
    ),
    "PL": (
        "매출", "수익", "비용", "이익", "손익계산서", "income statement", "profit", "loss", "매출액", "매출원가", "판매비와관리비", "영업이익",
        "당기순이익", "법인세비용", "금융비용", "금융수익",
    ),
}
#: Words of column names: a statement has the columns where each group has one, the first statement whose groups all do.
STATEMENT_COLUMNS = (
    ("BS", (("당기", "전기", "기말", "기초"), ("자산", "부채", "자본"))),
    ("CF", (("영업활동", "투자활동", "재무활동"),)),
    ("EQ", (("자본변동", "변동표"),)),
    ("CI", (("포괄손익", "기타포괄손익"),)),
    ("PL", (("매출", "수익", "비용"),)),
)
